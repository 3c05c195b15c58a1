"""Type planning: the reference's own mapper tests, the ladder boundaries, rules and precedence."""

import pytest
from pyspark.sql import functions as F

from lakeload.plans.rules import parse_rule_text
from lakeload.plans.typeplan import plan_types, read_type_map, recommended_names, type_map

SCHEMA = "table_name string, column_name string, position int, type_class string, precision int, scale int, nullable boolean"


def _cols(spark, rows):
    return spark.createDataFrame([("t", c, i + 1, tc, p, s, True) for i, (c, tc, p, s) in enumerate(rows)], SCHEMA)


def _plan(spark, rows, rules=None, default=None, inferred=None):
    out = plan_types(_cols(spark, rows), parse_rule_text(spark, rules) if rules else None, inferred, default)
    return {r["column_name"]: r for r in out.collect()}


def test_reference_suffix_patterns_tolerate_spaces(spark):
    p = _plan(spark, [("REASON_ID", "NUMERIC", 0, 0), ("CREATED_BY", "NUMERIC", 0, 0)],
              "%_ID:NUMBER=LONG ;  %ATED_BY:NUMBER=INTEGER ; ")
    assert p["REASON_ID"]["target_type"] == "long"
    assert p["CREATED_BY"]["target_type"] == "int"


def test_reference_pattern_beats_default_and_others_stay_decimal(spark):
    p = _plan(spark, [("CREATED_BY", "NUMERIC", 0, 0), ("LAST_UPDATE_LOGIN", "NUMERIC", 0, 0)],
              "%_ID:NUMBER=LONG; %ATED_BY:NUMBER=INTEGER")
    assert p["CREATED_BY"]["target_type"] == "int"
    assert p["LAST_UPDATE_LOGIN"]["target_type"].startswith("decimal")


def test_reference_exact_rules_and_default(spark):
    p = _plan(spark, [("INVOICE_ID", "NUMERIC", 0, 0), ("CURRENCY_AMOUNT", "NUMERIC", 0, 0), ("ID", "NUMERIC", 0, 0),
                      ("OTHER_AMOUNT", "NUMERIC", 0, 0)],
              "%_ID:NUMBER=LONG;CURRENCY_AMOUNT:NUMBER=DECIMAL(21,2);ID:NUMBER=INTEGER", default="number=decimal(37,11)")
    assert p["INVOICE_ID"]["target_type"] == "long"
    assert (p["CURRENCY_AMOUNT"]["target_type"], p["CURRENCY_AMOUNT"]["target_precision"],
            p["CURRENCY_AMOUNT"]["target_scale"]) == ("decimal(21,2)", 21, 2)
    assert p["ID"]["target_type"] == "int"
    # the default reaches columns no rule matches (bare and number= forms)
    assert p["OTHER_AMOUNT"]["target_type"] == "decimal(37,11)"
    assert _plan(spark, [("X", "NUMERIC", 0, 0)], default="decimal(20,5)")["X"]["target_type"] == "decimal(20,5)"


@pytest.mark.parametrize("p,s,expected", [
    (0, 0, "decimal(38,10)"), (0, -127, "decimal(38,10)"), (9, 0, "int"), (10, 0, "long"), (18, 0, "long"),
    (19, 0, "decimal(19,0)"), (38, 0, "decimal(38,0)"), (39, 0, "decimal(38,10)"), (12, 2, "decimal(12,2)"),
    (38, 37, "decimal(38,37)"), (5, 5, "decimal(5,5)"), (5, 6, "decimal(38,10)"), (5, -2, "int"),
    (126, -127, "decimal(38,10)"), (16, -2, "long"), (17, -2, "decimal(19,0)"), (37, -5, "decimal(38,0)"),
])
def test_number_ladder(spark, p, s, expected):
    assert _plan(spark, [("C", "NUMERIC", p, s)])["C"]["target_type"] == expected


def test_decimal_code_is_number_family(spark):
    assert _plan(spark, [("C", "DECIMAL", 12, 2)])["C"]["target_type"] == "decimal(12,2)"


@pytest.mark.parametrize("cls,expected,spark_type", [
    ("FLOAT", "float", "float"), ("DOUBLE", "double", "double"), ("BOOLEAN", "boolean", "boolean"),
    ("TINYINT", "int", "int"), ("SMALLINT", "int", "int"), ("INTEGER", "int", "int"), ("BIGINT", "long", "bigint"),
    ("VARCHAR", "string", "string"), ("NVARCHAR", "string", "string"), ("TIMESTAMP", "timestamp", "timestamp_ntz"),
    ("TIMESTAMP_WITH_TIMEZONE", "timestamptz", "timestamp"), ("DATE", "date", "date"), ("TIME", "time", "string"),
    ("BINARY", "binary", "binary"), ("CLOB", "string", "string"), ("ROWID", "string", "string"),
])
def test_other_types(spark, cls, expected, spark_type):
    r = _plan(spark, [("C", cls, 0, 0)])["C"]
    assert (r["target_type"], r["spark_type"]) == (expected, spark_type)


def test_rule_parsing_valid_and_invalid(spark):
    text = ("A:NUMBER=long; a:NUMBER=int; %_ID:NUMBER=bigint; LOC_%:NUMBER=decimal(38,0); X:NUMBER=decimal( 20 , 5 ); "
            "X:FLOAT=double; %MID%:NUMBER=int; A%B:NUMBER=int; X:DATE=long; X:NUMBER=text; X:NUMBER=decimal(5); nonsense")
    rows = {r["rule_pos"]: r for r in parse_rule_text(spark, text).collect()}
    assert [rows[i]["valid"] for i in range(1, 13)] == [True] * 6 + [False] * 6
    assert (rows[1]["match_kind"], rows[1]["match_text"], rows[1]["target_class"]) == ("exact", "A", "BIGINT")
    assert (rows[3]["match_kind"], rows[3]["match_text"]) == ("suffix", "_ID")
    assert (rows[4]["match_kind"], rows[4]["match_text"], rows[4]["target_precision"]) == ("prefix", "LOC_", 38)
    assert (rows[5]["target_precision"], rows[5]["target_scale"]) == (20, 5)
    assert rows[9]["problem"] == "source type must be NUMBER or FLOAT"


def test_first_matching_pattern_wins_and_exact_wins_over_pattern(spark):
    p = _plan(spark, [("ORDER_ID", "NUMERIC", 0, 0), ("ID_ORDER_ID", "NUMERIC", 0, 0)],
              "%_ID:NUMBER=int; ORDER%:NUMBER=long; ID_ORDER_ID:NUMBER=decimal(12,2)")
    assert p["ORDER_ID"]["target_type"] == "int" and p["ORDER_ID"]["rule_text"] == "%_ID:NUMBER=int"
    assert p["ID_ORDER_ID"]["target_type"] == "decimal(12,2)" and p["ID_ORDER_ID"]["rule_source"] == "exact"


def test_rules_only_touch_numeric_columns_and_match_case_insensitively(spark):
    p = _plan(spark, [("name_id", "VARCHAR", 0, 0), ("line_id", "NUMERIC", 0, 0)], "%_ID:NUMBER=int")
    assert p["name_id"]["target_type"] == "string"
    assert p["line_id"]["target_type"] == "int"


def test_override_reenters_ladder(spark):
    p = _plan(spark, [("A", "NUMERIC", 0, 0)], "A:NUMBER=decimal(9,0)")
    assert p["A"]["target_type"] == "int"


def test_inferred_between_exact_and_pattern(spark):
    inferred = spark.createDataFrame([("t", "A_ID", "decimal(12,2)"), ("t", "B_ID", "integer")],
                                     "table_name string, column_name string, recommended_type string")
    p = _plan(spark, [("A_ID", "NUMERIC", 0, 0), ("B_ID", "NUMERIC", 0, 0)], "%_ID:NUMBER=long; B_ID:NUMBER=double",
              inferred=inferred)
    assert p["A_ID"]["target_type"] == "decimal(12,2)" and p["A_ID"]["rule_source"] == "inferred"
    assert p["B_ID"]["target_type"] == "double" and p["B_ID"]["rule_source"] == "exact"


def test_type_map_round_trip(spark):
    plan = plan_types(_cols(spark, [("A", "NUMERIC", 5, 0), ("B", "VARCHAR", 0, 0)]))
    back = {r["column_name"]: r["target_type"] for r in read_type_map(type_map(plan)).collect()}
    assert back == {"A": "int", "B": "string"}
    # the map is accepted back as inferred types
    inferred = read_type_map(type_map(plan)).withColumnRenamed("target_type", "recommended_type")
    assert plan_types(_cols(spark, [("A", "NUMERIC", 30, 0)]), inferred=inferred).first()["target_type"] == "int"


def test_dictionary_names(spark):
    plan = plan_types(_cols(spark, [("A", "NUMERIC", 0, 0), ("B", "NUMERIC", 8, 0), ("C", "NUMERIC", 5, 7),
                                    ("D", "BLOB", 0, 0), ("E", "DATE", 0, 0)]))
    names = {r["column_name"]: r["recommended_type"] for r in recommended_names(plan, mode="dictionary").collect()}
    assert names == {"A": "decimal(38,0)", "B": "integer", "C": "decimal(5,5)", "D": "binary", "E": "timestamp"}


def test_classify_type_names(spark):
    from lakeload.functions.types import classify_type_name, type_code
    df = spark.createDataFrame([(n,) for n in ["NUMBER", "varchar2", "DATE", "TIMESTAMP(6)", "RAW",
                                               "TIMESTAMP(6) WITH TIME ZONE", "bigint", "array<float>"]], "n string")
    got = [(r[0], r[1]) for r in df.select(classify_type_name(F.col("n")), type_code(classify_type_name(F.col("n")))).collect()]
    assert got == [("NUMERIC", 2), ("VARCHAR", 12), ("TIMESTAMP", 93), ("TIMESTAMP", 93), ("VARBINARY", -3),
                   ("TIMESTAMP_WITH_TIMEZONE", 2014), ("BIGINT", -5), ("OTHER", 1111)]


def ladder_model(cls, p, s, dp=38, ds=10):
    """Plain-Python statement of the ladder."""
    if cls in ("NUMERIC", "DECIMAL"):
        if (p == 0 and s == 0) or (s < 0 and p < 1) or p > 38:
            return f"decimal({dp},{ds})"
        if s < 0:
            p, s = min(38, p - s), 0
        if s == 0 and p < 10:
            return "int"
        if s == 0 and p < 19:
            return "long"
        if 0 <= s <= p:
            return f"decimal({p},{s})"
        return f"decimal({dp},{ds})"
    fixed = {"FLOAT": "float", "DOUBLE": "double", "BOOLEAN": "boolean", "TINYINT": "int", "SMALLINT": "int",
             "INTEGER": "int", "BIGINT": "long", "VARCHAR": "string", "NVARCHAR": "string", "TIMESTAMP": "timestamp",
             "TIMESTAMP_WITH_TIMEZONE": "timestamptz", "DATE": "date", "TIME": "time", "BINARY": "binary"}
    return fixed.get(cls, "string")


from hypothesis import given, settings, strategies as st  # noqa: E402

_CLASSES = ["NUMERIC", "DECIMAL", "FLOAT", "DOUBLE", "BIGINT", "INTEGER", "VARCHAR", "DATE", "CLOB"]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(_CLASSES), st.integers(-5, 130), st.integers(-130, 40)),
                min_size=1, max_size=40),
       st.sampled_from([(38, 10), (37, 11), (20, 5)]))
def test_ladder_matches_model(spark, descriptors, default):
    rows = [(f"C{i}", c, p, s) for i, (c, p, s) in enumerate(descriptors)]
    plan = _plan(spark, rows, default=f"decimal({default[0]},{default[1]})")
    for name, c, p, s in rows:
        assert plan[name]["target_type"] == ladder_model(c, p, s, *default), (name, c, p, s)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["A_ID", "B_ID", "ID", "AMOUNT", "A_AMOUNT", "IDX"]),
                          st.sampled_from(["long", "int", "double", "decimal(12,2)", "decimal(9,0)"])),
                min_size=1, max_size=6),
       st.lists(st.sampled_from(["%_ID", "A_%", "%AMOUNT", "ID%"]), max_size=3))
def test_rules_match_model(spark, exact, patterns):
    names = ["A_ID", "B_ID", "ID", "AMOUNT", "A_AMOUNT", "IDX"]
    rules = [f"{n}:NUMBER={t}" for n, t in exact] + [f"{p}:NUMBER=double" for p in patterns]
    plan = _plan(spark, [(n, "NUMERIC", 0, 0) for n in names], "; ".join(rules))
    targets = {"long": ("BIGINT", 18, 0), "int": ("INTEGER", 9, 0), "double": ("DOUBLE", 0, 0),
               "decimal(12,2)": ("NUMERIC", 12, 2), "decimal(9,0)": ("NUMERIC", 9, 0)}
    for n in names:
        firsts = [t for m, t in exact if m == n]
        if firsts:
            expected = ladder_model(*targets[firsts[0]])
        elif any((p.startswith("%") and n.endswith(p[1:])) or (p.endswith("%") and n.startswith(p[:-1])) for p in patterns):
            expected = "double"
        else:
            expected = "decimal(38,10)"
        assert plan[n]["target_type"] == expected, (n, rules)


def test_bad_decimal_rules_are_reported(spark):
    from lakeload.plans.rules import parse_rule_text
    rows = parse_rule_text(spark, "A:NUMBER=decimal(99999999999,2); B:NUMBER=decimal(50,60); C:NUMBER=decimal(-3,1); D:NUMBER=decimal(38,38)").collect()
    assert [r["valid"] for r in sorted(rows, key=lambda r: r["rule_pos"])] == [False, False, False, True]
