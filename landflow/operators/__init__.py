"""Table operators, each a pure function over DataFrames."""
