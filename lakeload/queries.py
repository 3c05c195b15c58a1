"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the test tables.

Every query reads whole tables through the library's own operators.  Parameters (rules text, bucket
counts, thresholds) are fixed per query so that the DuckDB oracle in ``lakeload.oracle_queries`` can
state the same computation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeload.operators import profile as prof
from lakeload.sources.files import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


# ---------------------------------------------------------------- scans

@query("scan_number_columns")
def q_scan_number_columns(spark, d):
    from lakeload.sources.scan import number_columns
    return number_columns(read_table(spark, d, "lineitem"))


# ---------------------------------------------------------------- profiles

@query("profile_full")
def q_profile_full(spark, d):
    return prof.profile_numbers(read_table(spark, d, "lineitem"), table="lineitem")


@query("profile_one_scan")
def q_profile_one_scan(spark, d):
    """The full profile in one scan of its source, here a join (which would run once per column group otherwise)."""
    from lakeload.operators.profile_scan import profile_one_scan
    orders = read_table(spark, d, "orders").select("o_orderkey")
    li = read_table(spark, d, "lineitem")
    return profile_one_scan(li.join(orders, li["l_orderkey"] == orders["o_orderkey"], "left").drop("o_orderkey"), table="lineitem")


@query("recommend_types")
def q_recommend_types(spark, d):
    return prof.recommend_types(prof.profile_numbers(read_table(spark, d, "lineitem"), table="lineitem"))


@query("profile_partials")
def q_profile_partials(spark, d):
    """Partial profiles per key range of l_orderkey (4 ranges); each range is a load batch."""
    from lakeload.sources.scan import with_key_ranges
    li = with_key_ranges(read_table(spark, d, "lineitem"), "l_orderkey", 4)
    return prof.profile_numbers(li, by=["range_id"], table="lineitem")


@query("profile_merge")
def q_profile_merge(spark, d):
    """Partials over 8 hash buckets of the row, merged: must equal the full profile."""
    from lakeload.sources.scan import hash_buckets
    li = hash_buckets(read_table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"], 8)
    return prof.merge_profiles(prof.profile_numbers(li, by=["bucket"], table="lineitem"))


@query("profile_sample")
def q_profile_sample(spark, d):
    from lakeload.sources.scan import scan_sample
    li = read_table(spark, d, "lineitem")
    return prof.recommend_types(prof.profile_numbers(
        scan_sample(li, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]), table="lineitem"))


@query("profile_double")
def q_profile_double(spark, d):
    """Floating branch over every float/double column of lineitem, orders and events."""
    parts = [prof.profile_numbers(read_table(spark, d, t), table=t, floating=True)
             for t in ("lineitem", "orders", "events")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("recommend_lossless")
def q_recommend_lossless(spark, d):
    parts = [prof.recommend_types(prof.profile_numbers(read_table(spark, d, t), table=t), lossless=True)
             for t in ("lineitem", "orders", "customer")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("storage_estimate")
def q_storage_estimate(spark, d):
    return prof.storage_estimate(prof.recommend_types(
        prof.profile_numbers(read_table(spark, d, "lineitem"), table="lineitem"), lossless=True))


@query("sample_plan")
def q_sample_plan(spark, d):
    from lakeload.operators.keys import row_counts
    from lakeload.sources.files import TABLES
    from lakeload.sources.scan import sample_plan
    return sample_plan(row_counts({t: read_table(spark, d, t) for t in TABLES}))


@query("scan_sample")
def q_scan_sample(spark, d):
    from lakeload.sources.scan import scan_sample
    return scan_sample(read_table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


# ---------------------------------------------------------------- scans

@query("scan_table")
def q_scan_table(spark, d):
    from lakeload.sources.files import table_path
    from lakeload.sources.scan import scan_table
    return scan_table(spark, table_path(d, "orders"))


@query("scan_where")
def q_scan_where(spark, d):
    from lakeload.sources.files import table_path
    from lakeload.sources.scan import scan_table
    return scan_table(spark, table_path(d, "orders"),
                      where="WHERE o_orderstatus = 'F' AND o_totalprice > 100000",
                      columns=["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])


@query("scan_query")
def q_scan_query(spark, d):
    from lakeload.sources.files import register_views
    from lakeload.sources.scan import scan_table
    register_views(spark, d, ["customer", "nation"])
    return scan_table(spark, None, query="SELECT c_custkey, c_name, c_acctbal, n_name FROM customer "
                                         "JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment = 'BUILDING'")


@query("scan_row_key")
def q_scan_row_key(spark, d):
    """Row key on every lineitem row; checked as: one distinct key per row."""
    from pyspark.sql import functions as F
    from lakeload.sources.files import table_path
    from lakeload.sources.scan import scan_table
    df = scan_table(spark, table_path(d, "lineitem"), row_key="row_key", columns=["l_orderkey"])
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("row_key").alias("distinct_row_keys"))


@query("scan_key_ranges")
def q_scan_key_ranges(spark, d):
    from lakeload.sources.scan import key_ranges
    return key_ranges(read_table(spark, d, "orders"), "o_orderkey", 4)


@query("scan_balanced_ranges")
def q_scan_balanced_ranges(spark, d):
    """12 ranges of about the same number of events by user, a third of which belong to one user: that user is split by event."""
    from pyspark.sql import functions as F
    from lakeload.sources.ranges import balanced_ranges
    ev = read_table(spark, d, "events")
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(40)).otherwise(F.col("user_id")).cast("bigint")
    return balanced_ranges(ev.select(hot.alias("user_id"), "event_id"), "user_id", 12, "event_id")


@query("scan_hash_buckets")
def q_scan_hash_buckets(spark, d):
    """8 hash buckets of orders; per-bucket row and key counts summed: equal to the table's iff the
    buckets are disjoint and complete."""
    from pyspark.sql import functions as F
    from lakeload.sources.scan import hash_buckets
    b = hash_buckets(read_table(spark, d, "orders"), ["o_orderkey"], 8)
    per = b.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("o_orderkey").alias("keys"),
                                  F.min("bucket").alias("lo"), F.max("bucket").alias("hi"))
    return per.agg(F.sum("rows").cast("bigint").alias("row_count"), F.sum("keys").cast("bigint").alias("distinct_keys"),
                   ((F.min("lo") >= 0) & (F.max("hi") < 8)).alias("buckets_in_range"))


@query("scan_as_of")
def q_scan_as_of(spark, d):
    from lakeload.sources.scan import scan_as_of
    return scan_as_of(read_table(spark, d, "events"), "ts", as_of="2024-01-15 00:00:00")


# ---------------------------------------------------------------- keys and metadata

KEY_TABLES = ("orders", "lineitem", "customer", "documents")


@query("describe_columns")
def q_describe_columns(spark, d):
    from lakeload.operators.keys import describe_columns
    parts = [describe_columns(read_table(spark, d, t), t) for t in KEY_TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("row_counts")
def q_row_counts(spark, d):
    from lakeload.operators.keys import row_counts
    from lakeload.sources.files import TABLES
    return row_counts({t: read_table(spark, d, t) for t in TABLES})


@query("key_bounds")
def q_key_bounds(spark, d):
    from lakeload.sources.scan import key_bounds
    return key_bounds(read_table(spark, d, "orders"), "o_orderkey")


@query("check_key")
def q_check_key(spark, d):
    from lakeload.operators.keys import check_key
    return (check_key(read_table(spark, d, "orders"), ["o_orderkey"], "orders")
            .unionByName(check_key(read_table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem"))
            .unionByName(check_key(read_table(spark, d, "conversations"), ["conv_id", "turn"], "conversations")))


@query("key_violations")
def q_key_violations(spark, d):
    from lakeload.operators.keys import key_violations
    return key_violations(read_table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("key_candidates")
def q_key_candidates(spark, d):
    from lakeload.operators.keys import key_candidates
    parts = [key_candidates(read_table(spark, d, t), t) for t in ("orders", "customer", "lineitem")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("key_candidates_all")
def q_key_candidates_all(spark, d):
    """All minimal keys of orders, customer, lineitem and of a table of its shipments whose only key has three columns."""
    from pyspark.sql import functions as F
    from lakeload.operators.keys import minimal_keys
    tabs = {t: read_table(spark, d, t) for t in ("orders", "customer", "lineitem")}
    tabs["shipments"] = (tabs["lineitem"].groupBy("l_returnflag", "l_linestatus", "l_linenumber")
                         .agg(F.year(F.min("l_shipdate")).alias("first_year"), F.lit(1).alias("one")))
    out = None
    for name, df in tabs.items():
        keys = minimal_keys(df, name)
        out = keys if out is None else out.unionByName(keys)
    return out


@query("split_key")
def q_split_key(spark, d):
    from lakeload.operators.keys import describe_columns, key_candidates, split_key
    tabs = ("orders", "customer", "part", "supplier")
    cands = [key_candidates(read_table(spark, d, t), t) for t in tabs]
    cols = [describe_columns(read_table(spark, d, t), t) for t in tabs]
    c, k = cands[0], cols[0]
    for x, y in zip(cands[1:], cols[1:]):
        c, k = c.unionByName(x), k.unionByName(y)
    return split_key(c, k)


# ---------------------------------------------------------------- type planning

PLAN_TABLES = ("lineitem", "orders", "customer", "part", "supplier")

# Fixed parameters of the planning queries: a rule list with valid, shadowed, repeated and invalid rules.
RULES = ("%KEY:NUMBER=LONG; L_QUANTITY:number=integer; %PRICE:NUMBER=DECIMAL(12, 2); O_%:NUMBER=decimal(18,4); "
         "c_acctbal:NUMBER=double; P_SIZE:FLOAT=float; %MID%:NUMBER=int; A%B:NUMBER=long; X:DATE=long; "
         "L_TAX:NUMBER=text; L_DISCOUNT:NUMBER=decimal(5); nonsense; S_%:NUMBER=decimal(9,0); "
         "%KEY:NUMBER=LONG; ;")
EXACT_RULES = "L_QUANTITY:number=integer; c_acctbal:NUMBER=double; P_SIZE:FLOAT=float; L_TAX:NUMBER=text"
PATTERN_RULES = "%KEY:NUMBER=LONG; %PRICE:NUMBER=DECIMAL(12, 2); O_%:NUMBER=decimal(18,4); S_%:NUMBER=decimal(9,0)"
DEFAULT_NUMBER = "number=decimal(37,11)"


def _union_all(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def source_descriptors(spark, d, tables=PLAN_TABLES):
    """Descriptors of every column of the tables, numeric columns declared NUMBER(p,s) from a profile."""
    from lakeload.operators.keys import describe_columns
    from lakeload.plans.typeplan import number_declarations
    dfs = {t: read_table(spark, d, t) for t in tables}
    desc = _union_all([describe_columns(df, t) for t, df in dfs.items()])
    profile = _union_all([prof.profile_numbers(df, table=t) for t, df in dfs.items()])
    return number_declarations(desc, profile), profile


@query("plan_types_base")
def q_plan_types_base(spark, d):
    from lakeload.plans.typeplan import plan_types
    cols, _ = source_descriptors(spark, d)
    return plan_types(cols)


@query("plan_types_exact")
def q_plan_types_exact(spark, d):
    from lakeload.plans.rules import parse_rule_text
    from lakeload.plans.typeplan import plan_types
    cols, _ = source_descriptors(spark, d)
    return plan_types(cols, parse_rule_text(spark, EXACT_RULES))


@query("plan_types_pattern")
def q_plan_types_pattern(spark, d):
    from lakeload.plans.rules import parse_rule_text
    from lakeload.plans.typeplan import plan_types
    cols, _ = source_descriptors(spark, d)
    return plan_types(cols, parse_rule_text(spark, PATTERN_RULES))


@query("plan_types_default")
def q_plan_types_default(spark, d):
    from lakeload.plans.typeplan import plan_types
    cols, _ = source_descriptors(spark, d)
    return plan_types(cols, default=DEFAULT_NUMBER)


@query("plan_types")
def q_plan_types(spark, d):
    from lakeload.plans.rules import parse_rule_text
    from lakeload.plans.typeplan import plan_types
    cols, _ = source_descriptors(spark, d)
    return plan_types(cols, parse_rule_text(spark, RULES))


@query("type_rules")
def q_type_rules(spark, d):
    from lakeload.plans.rules import parse_rule_text
    from lakeload.plans.typeplan import plan_types, rule_usage
    cols, _ = source_descriptors(spark, d)
    rules = parse_rule_text(spark, RULES)
    return rule_usage(rules, plan_types(cols, rules))


@query("plan_types_inferred")
def q_plan_types_inferred(spark, d):
    from lakeload.plans.rules import parse_rule_text
    from lakeload.plans.typeplan import plan_types
    cols, profile = source_descriptors(spark, d)
    return plan_types(cols, parse_rule_text(spark, RULES), inferred=prof.recommend_types(profile))


@query("recommended_names")
def q_recommended_names(spark, d):
    """Report names in dictionary mode: profile recommendation for numeric columns, the dictionary
    ladder for the rest."""
    from lakeload.operators.keys import describe_columns
    from lakeload.plans.typeplan import plan_types, recommended_names
    dfs = {t: read_table(spark, d, t) for t in PLAN_TABLES}
    desc = _union_all([describe_columns(df, t) for t, df in dfs.items()])
    recs = prof.recommend_types(_union_all([prof.profile_numbers(df, table=t) for t, df in dfs.items()]))
    return recommended_names(plan_types(desc), recs, mode="dictionary")


@query("classify_types")
def q_classify_types(spark, d):
    from pyspark.sql import functions as F
    from lakeload.functions.types import classify_type_name, type_code
    from lakeload.operators.keys import describe_columns
    from lakeload.sources.files import TABLES
    desc = _union_all([describe_columns(read_table(spark, d, t), t) for t in TABLES])
    cls = classify_type_name(F.col("data_type"))
    return desc.select("table_name", "column_name", "data_type", cls.alias("type_class"),
                       type_code(cls).alias("type_code"))


@query("type_map")
def q_type_map(spark, d):
    """Type map JSON per table, read back into rows."""
    from lakeload.plans.rules import parse_rule_text
    from lakeload.plans.typeplan import plan_types, read_type_map, type_map
    cols, _ = source_descriptors(spark, d)
    return read_type_map(type_map(plan_types(cols, parse_rule_text(spark, RULES))))


# ---------------------------------------------------------------- conversions

def _lineitem_numbers(spark, d):
    """lineitem with derived values that overflow, need rounding, or are NULL (the test tables have
    no NULLs and no out-of-range values)."""
    from pyspark.sql import functions as F
    li = read_table(spark, d, "lineitem")
    price = F.col("l_extendedprice").try_cast("decimal(12,2)")
    return li.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        (price * F.lit(100000)).alias("amount_e5"),
        (price * F.lit(100000000000000)).alias("amount_e14"),
        price.alias("price_dec"),
        (price * F.lit(0.5).cast("decimal(1,1)")).alias("half_price"),
        F.nullif(F.col("l_linenumber"), F.lit(3)).alias("line_or_null"),
        F.when(F.col("l_linenumber") == 1, F.lit(float("inf"))).when(F.col("l_linenumber") == 2, F.lit(float("-inf")))
        .when(F.col("l_linenumber") == 3, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("odd_double"),
        F.pmod(F.col("l_linenumber"), F.lit(2)).alias("line_parity"))


def _cast(spark, d, targets, keep=("l_orderkey", "l_linenumber")):
    from lakeload.plans.apply import cast_columns
    src = _lineitem_numbers(spark, d)
    return cast_columns(src.select(*keep, *targets), targets, keep=keep)


@query("cast_int")
def q_cast_int(spark, d):
    return _cast(spark, d, {"l_quantity": "int", "amount_e5": "int", "line_or_null": "int"})


@query("cast_long")
def q_cast_long(spark, d):
    return _cast(spark, d, {"l_extendedprice": "bigint", "amount_e14": "bigint"})


@query("cast_decimal")
def q_cast_decimal(spark, d):
    return _cast(spark, d, {"half_price": "decimal(10,2)", "price_dec": "decimal(6,1)", "l_discount": "decimal(3,2)"})


@query("cast_infinite")
def q_cast_infinite(spark, d):
    from pyspark.sql import functions as F
    from lakeload.functions.casts import convert
    src = _lineitem_numbers(spark, d)
    c = convert(F.col("odd_double"), src.schema["odd_double"].dataType, "decimal(10,2)")
    return src.select("l_orderkey", "l_linenumber", c.value.alias("odd_decimal"), c.reason.alias("reason"))


@query("cast_float")
def q_cast_float(spark, d):
    return _cast(spark, d, {"l_extendedprice": "float", "line_or_null": "float", "l_tax": "double"})


@query("cast_boolean")
def q_cast_boolean(spark, d):
    return _cast(spark, d, {"line_parity": "boolean", "line_or_null": "boolean"})


@query("cast_timestamp")
def q_cast_timestamp(spark, d):
    from pyspark.sql import functions as F
    from lakeload.plans.apply import cast_columns
    o = read_table(spark, d, "orders").select(
        "o_orderkey", "o_orderdate", F.col("o_orderdate").cast("string").alias("orderdate_text"))
    return cast_columns(o, {"o_orderdate": "timestamp_ntz", "orderdate_text": "timestamp_ntz"}, keep=["o_orderkey"])


@query("cast_string")
def q_cast_string(spark, d):
    from pyspark.sql import functions as F
    from lakeload.plans.apply import cast_columns
    o = read_table(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderkey").alias("orderkey_text"), "o_orderdate", "o_orderstatus",
        F.col("o_totalprice").try_cast("decimal(12,2)").alias("total_dec"))
    return cast_columns(o, {"orderkey_text": "string", "o_orderdate": "string", "o_orderstatus": "string",
                            "total_dec": "string"}, keep=["o_orderkey"])


@query("cast_date_time")
def q_cast_date_time(spark, d):
    from pyspark.sql import functions as F
    from lakeload.plans.apply import cast_columns
    e = read_table(spark, d, "events").select("event_id", F.col("ts").alias("ts_date"), F.col("ts").alias("ts_time"))
    return cast_columns(e, {"ts_date": "date", "ts_time": "time"}, keep=["event_id"])


REJECT_TARGETS = {"amount_e5": "int", "amount_e14": "bigint", "price_dec": "decimal(6,1)", "line_or_null": "int"}


@query("cast_rejects")
def q_cast_rejects(spark, d):
    from lakeload.plans.apply import cast_rejects
    return cast_rejects(_lineitem_numbers(spark, d), REJECT_TARGETS, key=["l_orderkey", "l_linenumber"])


@query("cast_reject_summary")
def q_cast_reject_summary(spark, d):
    from lakeload.plans.apply import cast_rejects, reject_summary
    return reject_summary(cast_rejects(_lineitem_numbers(spark, d), REJECT_TARGETS,
                                       key=["l_orderkey", "l_linenumber"]))


@query("apply_type_plan")
def q_apply_type_plan(spark, d):
    """Plan orders' types from its profile and the rule list, then convert the whole table."""
    from lakeload.plans.apply import apply_type_plan
    from lakeload.plans.rules import parse_rule_text
    from lakeload.plans.typeplan import plan_types
    cols, _ = source_descriptors(spark, d, ("orders",))
    plan = plan_types(cols, parse_rule_text(spark, RULES))
    typed, _ = apply_type_plan(read_table(spark, d, "orders"), plan, "orders", key=["o_orderkey"])
    return typed


# ---------------------------------------------------------------- partition transforms

def _orders_for_partitions(spark, d):
    from pyspark.sql import functions as F
    return read_table(spark, d, "orders").withColumn("total_dec", F.col("o_totalprice").try_cast("decimal(12,2)"))


def _derived(df, key, spec):
    from lakeload.functions.transforms import add_partitions
    out, cols = add_partitions(df, spec)
    return out.select(*key, *cols)


@query("part_identity")
def q_part_identity(spark, d):
    """Rows per identity partition (o_orderstatus, o_orderpriority)."""
    from pyspark.sql import functions as F
    from lakeload.functions.transforms import add_partitions
    out, cols = add_partitions(read_table(spark, d, "orders"), ["o_orderstatus=IDENTITY", "o_orderpriority=identity"])
    return out.groupBy(*cols).agg(F.count(F.lit(1)).alias("rows"))


@query("part_year")
def q_part_year(spark, d):
    return _derived(read_table(spark, d, "orders"), ["o_orderkey"], ["o_orderdate=YEAR"])


@query("part_month")
def q_part_month(spark, d):
    return _derived(read_table(spark, d, "orders"), ["o_orderkey"], ["o_orderdate=MONTH"])


@query("part_day")
def q_part_day(spark, d):
    return _derived(read_table(spark, d, "orders"), ["o_orderkey"], ["o_orderdate=DAY"])


@query("part_hour")
def q_part_hour(spark, d):
    return _derived(read_table(spark, d, "events"), ["event_id"], ["ts=HOUR"])


@query("part_bucket")
def q_part_bucket(spark, d):
    """Bucket transforms of integers, timestamps (native) and strings (vectorised murmur3)."""
    return _derived(read_table(spark, d, "events"), ["event_id"],
                    ["event_id=BUCKET,16", "user_id=BUCKET,8", "ts=BUCKET,4", "event_type=BUCKET,8"])


@query("part_truncate")
def q_part_truncate(spark, d):
    return _derived(_orders_for_partitions(spark, d), ["o_orderkey"],
                    ["o_orderkey=TRUNCATE,1000", "o_orderpriority=TRUNCATE,3", "total_dec=TRUNCATE,50"])


@query("part_multi")
def q_part_multi(spark, d):
    """Rows per partition of a three-transform spec, in order."""
    from pyspark.sql import functions as F
    from lakeload.functions.transforms import add_partitions
    out, cols = add_partitions(read_table(spark, d, "orders"),
                               ["o_orderstatus=IDENTITY", "o_orderdate=YEAR", "o_orderkey=TRUNCATE,5000"])
    return out.groupBy(*cols).agg(F.count(F.lit(1)).alias("rows"))


# ---------------------------------------------------------------- sinks (each writes into a fresh folder
# under the session's checkpoint directory and returns what it reads back)

def _target(spark, name):
    from lakeload.session import work_path
    return work_path(spark, name)


@query("load_full")
def q_load_full(spark, d):
    """Full load of orders, twice: the table holds the source exactly once."""
    from lakeload.sinks.load import load
    from lakeload.sinks.table import read_version
    t = _target(spark, "orders_full")
    orders = read_table(spark, d, "orders")
    load(orders, t, "full")
    load(orders, t, "full")
    return read_version(spark, t)


@query("load_named")
def q_load_named(spark, d):
    """Full load of orders into a table named after its source, in lower case, under a base folder."""
    from lakeload.sinks.load import load
    from lakeload.sinks.table import read_version
    base = _target(spark, "named")
    load(read_table(spark, d, "orders"), base, "full", source_name="SALES.ORDERS", naming="lower")
    return read_version(spark, f"{base}/sales/orders")


@query("load_incremental")
def q_load_incremental(spark, d):
    """Events up to 2024-01-15 create the table; later events arrive without ``props`` and append."""
    from pyspark.sql import functions as F
    from lakeload.sinks.load import load
    from lakeload.sinks.table import read_version
    t = _target(spark, "events_incr")
    ev = read_table(spark, d, "events")
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    load(ev.where(F.col("ts") <= cut), t, "incremental")
    load(ev.where(F.col("ts") > cut).drop("props"), t, "incremental")
    return read_version(spark, t)


@query("load_merge")
def q_load_merge(spark, d):
    """Orders before 1998 loaded; orders from 1997 on arrive with status 'U' and are merged on the key
    (1997 rows update, later rows insert)."""
    from pyspark.sql import functions as F
    from lakeload.sinks.load import load
    from lakeload.sinks.table import read_version
    t = _target(spark, "orders_merge")
    orders = read_table(spark, d, "orders")
    load(orders.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")), t, "full")
    changes = (orders.where(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
               .withColumn("o_orderstatus", F.lit("U")))
    load(changes, t, "merge", key=["o_orderkey"])
    return read_version(spark, t)


@query("load_concurrent")
def q_load_concurrent(spark, d):
    """Four writers append quarters of orders to one table at the same time."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.sql import functions as F
    from lakeload.sinks.load import load
    from lakeload.sinks.table import read_version
    t = _target(spark, "orders_concurrent")
    orders = read_table(spark, d, "orders")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: load(orders.where(F.pmod("o_orderkey", F.lit(4)) == k), t, "incremental"), range(4)))
    return read_version(spark, t)


def _loaded_events(spark, d, name):
    """Events in three appends: until 10 January, until 20 January, the rest."""
    from pyspark.sql import functions as F
    from lakeload.sinks.load import load
    t, ev = _target(spark, name), read_table(spark, d, "events")
    cuts = [F.lit(f"2024-01-{day} 00:00:00").cast("timestamp_ntz") for day in (10, 20)]
    part = F.when(F.col("ts") <= cuts[0], 0).when(F.col("ts") <= cuts[1], 1).otherwise(2)
    for k in range(3):
        load(ev.where(part == k), t, "incremental", partitions=["event_type=IDENTITY"])
    return t


@query("scan_as_of_version")
def q_scan_as_of_version(spark, d):
    """A table of three appends as it was when the second one had been published."""
    from lakeload.sinks import table as tbl
    t = _loaded_events(spark, d, "events_as_of")
    return tbl.read_as_of(spark, t, tbl.commit_time(spark, t, tbl.committed_versions(spark, t)[1]))


@query("scan_changes")
def q_scan_changes(spark, d):
    """The rows that were added since the first of three appends, after a compaction."""
    from lakeload.sinks import table as tbl
    from lakeload.sinks.compaction import compact
    t = _loaded_events(spark, d, "events_changes")
    compact(spark, t)
    return tbl.read_added(spark, t, tbl.committed_versions(spark, t)[0])


@query("file_compaction")
def q_file_compaction(spark, d):
    """A table of three appends by type after its compaction: its rows, and that each type is one file."""
    from pyspark.sql import functions as F
    from lakeload.sinks.compaction import compact, file_counts
    from lakeload.sinks.table import current_version, read_version
    t = _loaded_events(spark, d, "events_compacted")
    compact(spark, t)
    files = file_counts(spark, t, current_version(spark, t)).groupBy("event_type").agg(F.sum("files").alias("files"))
    return read_version(spark, t).join(files, "event_type", "left")


@query("load_rejects")
def q_load_rejects(spark, d):
    """The reject table that a load writes in the same job as its rows."""
    from lakeload.sinks.load import load
    from lakeload.sinks.table import read_rejects
    t = _target(spark, "lineitem_rejects")
    load(_lineitem_numbers(spark, d), t, targets=REJECT_TARGETS, rejects=["l_orderkey", "l_linenumber"])
    return read_rejects(spark, t)


@query("load_merge_partitions")
def q_load_merge_partitions(spark, d):
    """Orders partitioned by year; those of 1997 are updated and new ones of 1996 arrive: only 1997 is written anew."""
    from pyspark.sql import functions as F
    from lakeload.sinks.load import load
    from lakeload.sinks.table import read_version
    t, spec = _target(spark, "orders_merge_partitions"), ["o_orderdate=YEAR"]
    orders = read_table(spark, d, "orders")
    load(orders, t, "full", partitions=spec)
    year = F.year("o_orderdate")
    changes = orders.where(year == 1997).withColumn("o_orderstatus", F.lit("U")).unionByName(
        orders.where(year == 1996).withColumn("o_orderkey", -F.col("o_orderkey") - 1))
    load(changes, t, "merge", key=["o_orderkey"], partitions=spec)
    return read_version(spark, t)


@query("load_partitioned")
def q_load_partitioned(spark, d):
    """lineitem written partitioned by ship year and return flag; rows per partition read back."""
    from pyspark.sql import functions as F
    from lakeload.sinks.load import load
    from lakeload.sinks.table import read_version
    t = _target(spark, "lineitem_parts")
    load(read_table(spark, d, "lineitem"), t, "full", partitions=["l_shipdate=YEAR", "l_returnflag=IDENTITY"])
    return (read_version(spark, t).groupBy("l_shipdate_year", "l_returnflag")
            .agg(F.count(F.lit(1)).alias("rows")))


@query("file_layout")
def q_file_layout(spark, d):
    """lineitem written with a 256 KiB target file size: rows per data file read back."""
    from pyspark.sql import functions as F
    from lakeload.sinks.load import load
    from lakeload.sinks.table import read_version
    t = _target(spark, "lineitem_files")
    load(read_table(spark, d, "lineitem"), t, "full", target_bytes=256 * 1024)
    return (read_version(spark, t).groupBy(F.col("_metadata.file_name").alias("file_name"))
            .agg(F.count(F.lit(1)).alias("rows")))


@query("load_summary")
def q_load_summary(spark, d):
    """Counters of a converting load of lineitem's derived values (rows and rejected values)."""
    from lakeload.sinks.load import load
    t = _target(spark, "lineitem_summary")
    s = load(_lineitem_numbers(spark, d), t, "full", targets=REJECT_TARGETS)
    return s.select("mode", "rows_written", "rejected_values")


# ---------------------------------------------------------------- metadata report

REPORT_KEYS = {"orders": ["o_orderkey"], "customer": ["c_custkey"], "part": ["p_partkey"],
               "lineitem": ["l_orderkey", "l_linenumber"]}


@query("metadata_report")
def q_metadata_report(spark, d):
    """Flattened metadata report (one row per column) of four tables with their declared keys verified."""
    from lakeload.operators.report import report_rows
    tables = {t: read_table(spark, d, t) for t in REPORT_KEYS}
    return report_rows(tables, REPORT_KEYS)


# ---------------------------------------------------------------- streaming (incremental file loads)

def _two_arrivals(spark, d, name):
    """A source folder receiving events in two arrivals, with a streaming load after each."""
    from pyspark.sql import functions as F
    from lakeload.streaming.incremental import stream_load
    ev = read_table(spark, d, "events")
    src, tgt, prof_t = _target(spark, f"{name}_src"), _target(spark, f"{name}_tgt"), _target(spark, f"{name}_prof")
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    ev.where(F.col("ts") <= cut).write.parquet(src)
    stream_load(spark, src, tgt, profile_target=prof_t, table="events")
    ev.where(F.col("ts") > cut).write.mode("append").parquet(src)
    stream_load(spark, src, tgt, profile_target=prof_t, table="events")
    return tgt, prof_t


@query("stream_load")
def q_stream_load(spark, d):
    """Two streaming runs over a folder that receives events twice: each file is loaded once."""
    from lakeload.sinks.table import read_version
    tgt, _ = _two_arrivals(spark, d, "stream_events")
    return read_version(spark, tgt)


@query("stream_profile")
def q_stream_profile(spark, d):
    """Profile of everything streamed so far, merged from per-batch partial profiles."""
    from lakeload.streaming.incremental import loaded_profile
    _, prof_t = _two_arrivals(spark, d, "stream_profile")
    return loaded_profile(spark, prof_t)
