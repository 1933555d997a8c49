from __future__ import annotations

import json

import pytest
from pyspark.sql import types as T

from landflow.config import ConfigError, EntityConfig, load_configs, output_name, parse_type, pick_config
from landflow.operators.duplicates import DuplicatePolicy, choose_policy
from landflow.plans.cleaning import CSV_ORDER, WORKBOOK_ORDER, rule_order


def test_parse_type():
    assert parse_type("decimal(18,4)") == T.DecimalType(18, 4)
    assert parse_type("decimal") == T.DecimalType(30, 15)
    assert parse_type("timestamp") == T.TimestampType()
    with pytest.raises(ConfigError):
        parse_type("blob")


def test_no_checks_guard():
    off = EntityConfig.from_dict({"column_type_map": {"a": "string"}, "dq_checks": {"trim_spaces": False}})
    with pytest.raises(ConfigError):
        off.require_checks()
    with pytest.raises(ConfigError):
        EntityConfig().require_checks()
    EntityConfig(notnull_columns=("a",)).require_checks()


def test_load_and_pick_configs():
    text = json.dumps(
        {
            "ORDERS": {"column_type_map": {"a": "string"}, "load_type": "snapshot", "unheard_of": 1},
            "BOOK": {"first sheet": {"required_column_list": ["x"]}, "second": {"required_column_list": ["y"]}},
        }
    )
    configs = load_configs(text)
    assert set(configs) == {("ORDERS", ""), ("BOOK", "first sheet"), ("BOOK", "second")}
    assert configs["ORDERS", ""].extra == {"unheard_of": 1}
    assert set(pick_config(configs, "BOOK_20240101.csv")) == {"first sheet", "second"}
    assert set(pick_config(configs, "stray.csv")) == {""}
    assert output_name("BOOK", "first sheet", 2) == "BOOK~first_sheet"
    assert output_name("ORDERS", "", 1) == "ORDERS"
    with pytest.raises(ConfigError):
        EntityConfig.from_dict({"load_type": "sometimes"})


def test_rule_order_depends_on_the_file_kind():
    assert rule_order(EntityConfig(input_file_extension="csv")) == CSV_ORDER
    assert rule_order(EntityConfig(input_file_extension="XLSX")) == WORKBOOK_ORDER


def test_duplicate_policy_by_region_then_by_switch():
    assert choose_policy("AMS", {"ams": "skip"}) is DuplicatePolicy.SKIP
    assert choose_policy("apj", {"AMS": "skip"}, 0) is DuplicatePolicy.DROP
    assert choose_policy("apj", {}, 1) is DuplicatePolicy.TOLERATE
    assert choose_policy("apj", {}) is DuplicatePolicy.REJECT
