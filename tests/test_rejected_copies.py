"""Equal rows of a file: dropped copies have landed, and copies in a file with a faulty header are no duplicates."""

from __future__ import annotations

import datetime as dt

from landflow.config import EntityConfig
from landflow.plans import entity_load, run
from landflow.sources import readers
from tests.conftest import rows

NOW = dt.datetime(2024, 3, 1, 6, tzinfo=dt.timezone.utc)


def test_dropped_copies_count_as_landed(spark, tmp_path):
    """configured_audit: rejected rows that equal one another had landed once in the audit."""
    checks = {"trim_spaces": True, "null_notnull_check": True, "row_duplicate_check": True}
    declared = {"column_type_map": {"id": "string", "amount": "decimal(18,2)"}, "dq_checks": checks, "load_type": "full"}
    listed = {"required_column_list": ["id", "amount"], "allow_duplicates": 0, "load_type": "full"}
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "one.csv").write_text("id,amount\na,1\n,2\n,2\n,2\nb,3\nb,3\n")
    for name, given in (("declared", declared), ("listed", listed)):
        config = EntityConfig.from_dict(given | {"notnull_columns": ["id"]})
        assert run.run_entity(spark, str(landing), config, str(tmp_path / name), NOW, "b1", "e", parts=1) == "Succeeded"
        counts = run.audit_of(spark, str(tmp_path / name)).where("processname = 'LandingToRaw'").select("landingcount", "rawcount", "rejectcount")
        assert rows(counts) == [(6, 2, 4)]
        assert spark.read.parquet(str(tmp_path / name / "rejects" / "e")).count() == 1


def test_equal_rows_under_a_faulty_header_keep_its_faults(spark, tmp_path):
    """header_mapping: of equal rows without an id, all but one were reported as copies of one another."""
    (tmp_path / "one.csv").write_text("amount\n5\n5\n5\n")
    (tmp_path / "two.csv").write_text("amount,id\n5,a\n5,a\n")
    config = EntityConfig.from_dict({"required_column_list": ["id", "amount"], "notnull_columns": ["id"]})
    found = entity_load.check_entity(readers.read_entity(spark, str(tmp_path), config), config)
    assert rows(found.clean.select("id", "amount")) == [("a", "5")]
    reasons = sorted(r.reject_reason for r in found.rejects.collect())
    assert reasons == [["id_missing_in_header", "id_null_check_failed"]] * 3 + [["row level duplicate"]]
