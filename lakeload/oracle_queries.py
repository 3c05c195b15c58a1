"""DuckDB SQL for each registered query (same names as ``lakeload.queries.QUERIES``)."""

from __future__ import annotations

from lakeload import oracle as o

SQL: dict[str, str] = {}

LI = o.numeric_cols("lineitem")

SQL["scan_number_columns"] = ("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, "
                              "l_extendedprice, l_discount, l_tax FROM lineitem")

SQL["profile_full"] = o.profile_sql("lineitem", "lineitem", LI)

SQL["profile_one_scan"] = o.profile_sql("lineitem LEFT JOIN orders ON l_orderkey = o_orderkey", "lineitem", LI)

SQL["recommend_types"] = f"SELECT *, {o.recommend_sql()} AS recommended_type FROM ({o.profile_sql('lineitem', 'lineitem', LI)})"


def _range_id_sql(key: str, table: str, n: int) -> tuple[str, str]:
    """(bounds subquery, range id expression) of an n-way key range split."""
    bounds = (f"(SELECT min({key}) AS lo, max({key}) AS hi, "
              f"greatest(1, (max({key}) - min({key}) + 1) // {n}) AS size FROM {table}) b")
    rid = (f"CAST(CASE WHEN {key} IS NULL THEN 0 ELSE greatest(0, least({n - 1}, "
           f"CAST(floor(({key} - b.lo) / b.size) AS INTEGER))) END AS INTEGER)")
    return bounds, rid


_b, _rid = _range_id_sql("l_orderkey", "lineitem", 4)
SQL["profile_partials"] = o.profile_sql(f"(SELECT lineitem.*, {_rid} AS range_id FROM lineitem, {_b})",
                                        "lineitem", LI, group_by="range_id")
SQL["profile_merge"] = o.profile_sql("lineitem", "lineitem", LI)

_FLOATS = {t: [c for c in o.numeric_cols(t) if c[1] in ("double", "float")] for t in ("lineitem", "orders", "events")}
SQL["profile_double"] = o.union(o.profile_sql(t, t, cols, floating=True) for t, cols in _FLOATS.items())

SQL["recommend_lossless"] = o.union(
    f"SELECT *, {o.lossless_sql()} AS recommended_type FROM ({o.profile_sql(t, t, o.numeric_cols(t))})"
    for t in ("lineitem", "orders", "customer"))


def _width_sql(name: str) -> str:
    p = f"TRY_CAST(regexp_extract({name}, '^decimal\\((\\d+),', 1) AS INTEGER)"
    return (f"(CASE WHEN {name} IN ('integer', 'int', 'float') THEN 4 WHEN {name} IN ('long', 'bigint', 'double') "
            f"THEN 8 WHEN {p} <= 9 THEN 4 WHEN {p} <= 18 THEN 8 WHEN {p} IS NOT NULL THEN 16 END)")


SQL["storage_estimate"] = (
    f"SELECT table_name, column_name, recommended_type, total_values - null_values AS stored_values, "
    f"CAST((total_values - null_values) * 16 AS BIGINT) AS bytes_before, "
    f"CAST((total_values - null_values) * {_width_sql('recommended_type')} AS BIGINT) AS bytes_after FROM "
    f"(SELECT *, {o.lossless_sql()} AS recommended_type FROM ({o.profile_sql('lineitem', 'lineitem', LI)}))")

_COUNTS = o.union(f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM {t}" for t in o.SCHEMAS)
SQL["row_counts"] = _COUNTS
SQL["sample_plan"] = (
    "SELECT table_name, row_count, sample_size, CASE WHEN row_count > 0 THEN "
    "least(100.0::DOUBLE, CAST(sample_size AS DOUBLE) / CAST(row_count AS DOUBLE) * 100.0::DOUBLE) END AS sample_percent "
    "FROM (SELECT table_name, row_count, CAST(CASE WHEN row_count // 20 < 10000 THEN least(row_count, 10000) "
    "WHEN row_count // 20 > 100000 THEN 100000 ELSE row_count // 20 END AS BIGINT) AS sample_size "
    f"FROM ({_COUNTS}))")

# ---------------------------------------------------------------- scans

SQL["scan_table"] = "SELECT * FROM orders"
SQL["scan_where"] = ("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders "
                     "WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
SQL["scan_query"] = ("SELECT c_custkey, c_name, c_acctbal, n_name FROM customer JOIN nation "
                     "ON c_nationkey = n_nationkey WHERE c_mktsegment = 'BUILDING'")
SQL["scan_row_key"] = "SELECT count(*) AS row_count, count(*) AS distinct_row_keys FROM lineitem"

_b, _rid = _range_id_sql("o_orderkey", "orders", 4)
SQL["scan_key_ranges"] = (
    f"SELECT range_id, CAST(lo + range_id * size AS BIGINT) AS lo, "
    f"CAST(CASE WHEN range_id = 3 THEN hi ELSE lo + (range_id + 1) * size - 1 END AS BIGINT) AS hi, "
    f"count(*) AS rows FROM (SELECT {_rid} AS range_id, b.lo, b.hi, b.size FROM orders, {_b}) "
    f"GROUP BY range_id, lo, hi, size")
# each range begins where its share of the ordered rows does; a key with over 1/20 of a mean range is split by event_id
_SKEWED = "SELECT CASE WHEN event_id % 3 = 0 THEN 40 ELSE user_id END AS user_id, event_id FROM events"
SQL["scan_balanced_ranges"] = (
    f"WITH ev AS ({_SKEWED}), total AS (SELECT count(*) AS n FROM ev), "
    "ordered AS (SELECT user_id, event_id, row_number() OVER (ORDER BY user_id NULLS FIRST, event_id NULLS FIRST) - 1 AS pos, "
    "count(*) OVER (PARTITION BY user_id) AS rows FROM ev), "
    "cuts AS (SELECT user_id AS cut_user, CASE WHEN rows * 12 * 20 > total.n THEN event_id ELSE -1 END AS cut_event "
    "FROM ordered, total, range(1, 12) r(i) WHERE pos = total.n * i // 12), "
    "tagged AS (SELECT ev.user_id, (SELECT count(*) FROM cuts WHERE ev.user_id > cut_user OR ev.user_id = cut_user "
    "AND ev.event_id >= cut_event) AS range_id FROM ev) "
    "SELECT CAST(range_id AS INTEGER) AS range_id, count(*) AS rows, min(user_id) AS lo, max(user_id) AS hi FROM tagged GROUP BY range_id")
SQL["scan_hash_buckets"] = ("SELECT count(*) AS row_count, count(DISTINCT o_orderkey) AS distinct_keys, "
                            "true AS buckets_in_range FROM orders")
SQL["scan_as_of"] = "SELECT * FROM events WHERE ts <= TIMESTAMP '2024-01-15 00:00:00'"

# ---------------------------------------------------------------- keys and metadata


def _describe_sql(table: str) -> str:
    parts = []
    for pos, (name, typ) in enumerate(o.SCHEMAS[table], start=1):
        cls, prec = o.TYPE_CLASS.get(typ, ("OTHER", 0))
        width = (f"CAST(max(length({name})) AS INTEGER)" if typ in ("string", "binary")
                 else "CAST(NULL AS INTEGER)")
        parts.append(f"SELECT '{table}' AS table_name, '{name}' AS column_name, {pos} AS position, "
                     f"'{typ}' AS data_type, '{cls}' AS type_class, {prec} AS precision, 0 AS scale, "
                     f"true AS nullable, CAST(count(*) - count({name}) AS BIGINT) AS null_count, "
                     f"{width} AS max_length FROM {table}")
    return o.union(parts)


SQL["describe_columns"] = o.union(_describe_sql(t) for t in ("orders", "lineitem", "customer", "documents"))
SQL["key_bounds"] = ("SELECT min(o_orderkey) AS min_key, max(o_orderkey) AS max_key, "
                     "max(o_orderkey) - min(o_orderkey) + 1 AS key_span FROM orders")


def _check_key_sql(table: str, cols: list[str]) -> str:
    keys = ", ".join(cols)
    nullk = " OR ".join(f"{c} IS NULL" for c in cols)
    dup = "rows > 1 AND NOT null_key"
    return (f"SELECT '{table}' AS table_name, '{','.join(cols)}' AS key_columns, "
            f"CAST(coalesce(sum(rows), 0) AS BIGINT) AS total_rows, CAST(count_if(NOT null_key) AS BIGINT) AS distinct_keys, "
            f"CAST(count_if({dup}) AS BIGINT) AS duplicate_groups, "
            f"CAST(coalesce(sum(CASE WHEN {dup} THEN rows END), 0) AS BIGINT) AS duplicate_rows, "
            f"CAST(coalesce(sum(CASE WHEN null_key THEN rows END), 0) AS BIGINT) AS null_key_rows, "
            f"(count_if({dup}) = 0 AND coalesce(sum(CASE WHEN null_key THEN rows END), 0) = 0) AS is_key "
            f"FROM (SELECT {keys}, count(*) AS rows, bool_or({nullk}) AS null_key FROM {table} GROUP BY {keys})")


SQL["check_key"] = o.union([_check_key_sql("orders", ["o_orderkey"]),
                            _check_key_sql("lineitem", ["l_orderkey", "l_linenumber"]),
                            _check_key_sql("conversations", ["conv_id", "turn"])])
SQL["key_violations"] = (
    "SELECT l_orderkey, l_linenumber, count(*) AS rows, CASE WHEN bool_or(l_orderkey IS NULL OR l_linenumber IS NULL) "
    "THEN 'null_key' ELSE 'duplicate' END AS violation FROM lineitem GROUP BY l_orderkey, l_linenumber "
    "HAVING count(*) > 1 OR bool_or(l_orderkey IS NULL OR l_linenumber IS NULL)")

_KEYABLE = {"bigint", "int", "smallint", "tinyint", "string", "timestamp_ntz", "timestamp", "date", "boolean", "binary"}


def _candidates_sql(table: str) -> str:
    cols = [n for n, t in o.SCHEMAS[table] if t in _KEYABLE or t.startswith("decimal")]
    singles = o.union(
        f"SELECT '{table}' AS table_name, '{c}' AS key_columns, 1 AS column_count, "
        f"CAST(count(DISTINCT {c}) AS BIGINT) AS distinct_keys, CAST(count(*) AS BIGINT) AS row_count FROM {table} "
        f"HAVING count(DISTINCT {c}) = count(*) AND count({c}) = count(*)" for c in cols)
    pairs = o.union(
        f"SELECT '{table}' AS table_name, '{a},{b}' AS key_columns, 2 AS column_count, "
        f"(SELECT CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT {a}, {b} FROM {table})) AS distinct_keys, "
        f"CAST(count(*) AS BIGINT) AS row_count FROM {table} "
        f"HAVING count({a}) = count(*) AND count({b}) = count(*) AND "
        f"(SELECT count(*) FROM (SELECT DISTINCT {a}, {b} FROM {table})) = count(*)"
        for i, a in enumerate(cols) for b in cols[i + 1:])
    return (f"SELECT * FROM ({singles}) UNION ALL SELECT * FROM ({pairs}) "
            f"WHERE NOT EXISTS (SELECT 1 FROM ({singles}))")


SQL["key_candidates"] = o.union(f"SELECT * FROM ({_candidates_sql(t)})" for t in ("orders", "customer", "lineitem"))


def _all_keys_sql(table: str, source: str, cols: list[str]) -> str:
    """Unique sets among all sets of ``cols`` that hold no smaller one."""
    sets = []
    for mask in range(1, 1 << len(cols)):
        own = [c for i, c in enumerate(cols) if mask >> i & 1]
        full = " AND ".join(f"count({c}) = count(*)" for c in own)
        sets.append(f"SELECT {mask} AS mask, '{','.join(own)}' AS key_columns, {len(own)} AS column_count, CAST(count(*) AS BIGINT) AS row_count, "
                    f"({full}) AND (SELECT count(*) FROM (SELECT DISTINCT {', '.join(own)} FROM {source})) = count(*) AS ok FROM {source}")
    return (f"SELECT '{table}' AS table_name, key_columns, column_count, row_count AS distinct_keys, row_count FROM "
            f"(WITH u AS ({o.union(sets)}) SELECT * FROM u WHERE ok AND row_count > 0 AND NOT EXISTS "
            f"(SELECT 1 FROM u v WHERE v.ok AND v.mask <> u.mask AND (v.mask & u.mask) = v.mask))")


_SHIPMENTS = ("(SELECT l_returnflag, l_linestatus, l_linenumber, CAST(year(min(l_shipdate)) AS INTEGER) AS first_year, 1 AS one "
              "FROM lineitem GROUP BY l_returnflag, l_linestatus, l_linenumber)")
SQL["key_candidates_all"] = o.union(
    [_all_keys_sql(t, t, [n for n, k in o.SCHEMAS[t] if k in _KEYABLE or k.startswith("decimal")]) for t in ("orders", "customer", "lineitem")]
    + [_all_keys_sql("shipments", _SHIPMENTS, ["l_returnflag", "l_linestatus", "l_linenumber", "first_year", "one"])])


def _split_sql(table: str) -> str:
    parts = []
    for pos, (c, t) in enumerate(o.SCHEMAS[table], start=1):
        if t in ("bigint", "int", "smallint", "tinyint"):
            parts.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, {pos} AS position, "
                         f"'{o.TYPE_CLASS[t][0]}' AS type_class FROM {table} "
                         f"HAVING count(DISTINCT {c}) = count(*) AND count({c}) = count(*)")
    return o.union(parts)


SQL["split_key"] = ("SELECT table_name, arg_min(column_name, position) AS split_column, "
                    "arg_min(type_class, position) AS type_class FROM ("
                    + o.union(_split_sql(t) for t in ("orders", "customer", "part", "supplier"))
                    + ") GROUP BY table_name")

# ---------------------------------------------------------------- type planning

_PLAN_TABLES = ("lineitem", "orders", "customer", "part", "supplier")
_DECL = o.declared_sql(_PLAN_TABLES)
# Expected parse of the fixed rule lists (written out by hand: an independent check of the parser).
_EXACT = [(2, "L_QUANTITY:number=integer", "exact", "L_QUANTITY", "INTEGER", 9, 0),
          (5, "c_acctbal:NUMBER=double", "exact", "C_ACCTBAL", "DOUBLE", 0, 0),
          (6, "P_SIZE:FLOAT=float", "exact", "P_SIZE", "FLOAT", 0, 0)]
_PATTERN = [(1, "%KEY:NUMBER=LONG", "suffix", "KEY", "BIGINT", 18, 0),
            (3, "%PRICE:NUMBER=DECIMAL(12, 2)", "suffix", "PRICE", "NUMERIC", 12, 2),
            (4, "O_%:NUMBER=decimal(18,4)", "prefix", "O_", "NUMERIC", 18, 4),
            (13, "S_%:NUMBER=decimal(9,0)", "prefix", "S_", "NUMERIC", 9, 0)]
_ALL = sorted(_EXACT + _PATTERN)
# In the exact-only and pattern-only lists the rules sit at other positions.
_EXACT_ONLY = [(1, *_EXACT[0][1:]), (2, *_EXACT[1][1:]), (3, *_EXACT[2][1:])]
_PATTERN_ONLY = [(i + 1, *r[1:]) for i, r in enumerate(_PATTERN)]

SQL["plan_types_base"] = o.plan_sql(_DECL, [])
SQL["plan_types_exact"] = o.plan_sql(_DECL, _EXACT_ONLY)
SQL["plan_types_pattern"] = o.plan_sql(_DECL, _PATTERN_ONLY)
SQL["plan_types_default"] = o.plan_sql(_DECL, [], dp=37, ds=11)
SQL["plan_types"] = o.plan_sql(_DECL, _ALL)
_RECS = o.union(f"SELECT table_name, column_name, {o.recommend_sql()} AS recommended_type "
                f"FROM ({o.profile_sql(t, t, o.numeric_cols(t))})" for t in _PLAN_TABLES)
SQL["plan_types_inferred"] = o.plan_sql(_DECL, _ALL, inferred_sql=_RECS)
SQL["type_map"] = f"SELECT table_name, column_name, target_type FROM ({o.plan_sql(_DECL, _ALL)})"

# Parsed rule list with the number of columns each rule decided.
_RULE_ROWS = [
    (1, "%KEY:NUMBER=LONG", "suffix", "KEY", "NUMBER", "BIGINT", 18, 0, True, None),
    (2, "L_QUANTITY:number=integer", "exact", "L_QUANTITY", "NUMBER", "INTEGER", 9, 0, True, None),
    (3, "%PRICE:NUMBER=DECIMAL(12, 2)", "suffix", "PRICE", "NUMBER", "NUMERIC", 12, 2, True, None),
    (4, "O_%:NUMBER=decimal(18,4)", "prefix", "O_", "NUMBER", "NUMERIC", 18, 4, True, None),
    (5, "c_acctbal:NUMBER=double", "exact", "C_ACCTBAL", "NUMBER", "DOUBLE", 0, 0, True, None),
    (6, "P_SIZE:FLOAT=float", "exact", "P_SIZE", "FLOAT", "FLOAT", 0, 0, True, None),
    (7, "%MID%:NUMBER=int", None, "%MID%", "NUMBER", "INTEGER", 9, 0, False, "pattern must be %SUFFIX or PREFIX%"),
    (8, "A%B:NUMBER=long", None, "A%B", "NUMBER", "BIGINT", 18, 0, False, "pattern must be %SUFFIX or PREFIX%"),
    (9, "X:DATE=long", "exact", "X", "DATE", "BIGINT", 18, 0, False, "source type must be NUMBER or FLOAT"),
    (10, "L_TAX:NUMBER=text", "exact", "L_TAX", "NUMBER", None, None, None, False, "unknown target type"),
    (11, "L_DISCOUNT:NUMBER=decimal(5)", "exact", "L_DISCOUNT", "NUMBER", None, None, None, False,
     "unknown target type"),
    (12, "nonsense", "exact", "NONSENSE", "NONSENSE", None, None, None, False, "no column before ':'"),
    (13, "S_%:NUMBER=decimal(9,0)", "prefix", "S_", "NUMBER", "NUMERIC", 9, 0, True, None),
    (14, "%KEY:NUMBER=LONG", "suffix", "KEY", "NUMBER", "BIGINT", 18, 0, True, None),
]


def _lit(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return str(v)
    return "'" + v.replace("'", "''") + "'"


_RULE_VALUES = ", ".join("(" + ", ".join(_lit(x) for x in r) + ")" for r in _RULE_ROWS)
SQL["type_rules"] = (
    "SELECT r.rule_text, CAST(r.rule_pos AS INTEGER) AS rule_pos, CAST(r.match_kind AS VARCHAR) AS match_kind, "
    "r.match_text, r.source_type, CAST(r.target_class AS VARCHAR) AS target_class, "
    "CAST(r.target_precision AS INTEGER) AS target_precision, CAST(r.target_scale AS INTEGER) AS target_scale, "
    "r.valid, CAST(r.problem AS VARCHAR) AS problem, CAST(coalesce(u.n, 0) AS BIGINT) AS columns_decided "
    f"FROM (VALUES {_RULE_VALUES}) r(rule_pos, rule_text, match_kind, match_text, source_type, target_class, "
    "target_precision, target_scale, valid, problem) LEFT JOIN (SELECT rule_text, count(*) AS n FROM ("
    f"{o.plan_sql(_DECL, _ALL)}) WHERE rule_source IN ('exact', 'pattern') GROUP BY rule_text) u "
    "ON r.rule_text = u.rule_text AND r.rule_pos <> 14")  # the repetition of rule 1 decides nothing


def _dictionary_name_sql() -> str:
    p0 = "(CASE WHEN precision > 0 THEN precision ELSE 38 END)"
    s = "(CASE WHEN scale > 0 THEN scale ELSE 0 END)"
    p = f"least({p0}, 38)"
    return (f"CASE WHEN type_class IN ('TINYINT', 'SMALLINT', 'INTEGER') THEN 'integer' "
            f"WHEN type_class = 'BIGINT' THEN 'long' "
            f"WHEN type_class IN ('NUMERIC', 'DECIMAL') THEN (CASE WHEN {s} = 0 AND {p0} < 10 THEN 'integer' "
            f"WHEN {s} = 0 AND {p0} < 19 THEN 'long' ELSE 'decimal(' || CAST({p} AS VARCHAR) || ',' || "
            f"CAST(least({s}, {p}) AS VARCHAR) || ')' END) "
            f"WHEN type_class = 'FLOAT' THEN 'float' WHEN type_class = 'DOUBLE' THEN 'double' "
            f"WHEN type_class = 'BOOLEAN' THEN 'boolean' "
            f"WHEN type_class IN ('TIMESTAMP', 'TIMESTAMP_WITH_TIMEZONE') THEN 'timestamp' "
            f"WHEN type_class = 'DATE' THEN 'timestamp' "
            f"WHEN type_class IN ('BINARY', 'VARBINARY', 'LONGVARBINARY', 'BLOB') THEN 'binary' ELSE 'string' END")


_DESC_PLAN = o.union(
    f"SELECT '{t}' AS table_name, '{n}' AS column_name, {pos} AS position, '{o.TYPE_CLASS.get(typ, ('OTHER', 0))[0]}' "
    f"AS type_class, {o.TYPE_CLASS.get(typ, ('OTHER', 0))[1]} AS precision, 0 AS scale"
    for t in _PLAN_TABLES for pos, (n, typ) in enumerate(o.SCHEMAS[t], start=1))
SQL["recommended_names"] = (
    f"SELECT d.table_name, d.column_name, d.position, coalesce(r.recommended_type, {_dictionary_name_sql()}) "
    f"AS recommended_type, CASE WHEN r.recommended_type IS NOT NULL THEN 'profile' ELSE 'dictionary' END AS basis "
    f"FROM ({_DESC_PLAN}) d LEFT JOIN ({_RECS}) r ON d.table_name = r.table_name AND d.column_name = r.column_name")

_CLASS_OF = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "timestamp_ntz": "TIMESTAMP", "array<float>": "OTHER"}
_CODES = {"BIGINT": -5, "INTEGER": 4, "DOUBLE": 8, "VARCHAR": 12, "TIMESTAMP": 93, "OTHER": 1111}
SQL["classify_types"] = o.union(
    f"SELECT '{t}' AS table_name, '{n}' AS column_name, '{typ}' AS data_type, '{_CLASS_OF[typ]}' AS type_class, "
    f"{_CODES[_CLASS_OF[typ]]} AS type_code FROM (SELECT count(*) FROM {t})"
    for t in o.SCHEMAS for n, typ in o.SCHEMAS[t])

# ---------------------------------------------------------------- conversions

_PRICE = "TRY_CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(12,2))"
_LI_NUM = (
    "(SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
    f"{_PRICE} * 100000 AS amount_e5, {_PRICE} * 100000000000000 AS amount_e14, {_PRICE} AS price_dec, "
    f"{_PRICE} * 0.5 AS half_price, nullif(l_linenumber, 3) AS line_or_null, "
    "CASE WHEN l_linenumber = 1 THEN 'inf'::DOUBLE WHEN l_linenumber = 2 THEN '-inf'::DOUBLE "
    "WHEN l_linenumber = 3 THEN 'nan'::DOUBLE ELSE l_tax END AS odd_double, "
    "l_linenumber % 2 AS line_parity FROM lineitem)")


def _to_int(x: str, typ: str = "INTEGER") -> str:
    return f"TRY_CAST(trunc({x}) AS {typ})"


def _to_dec(x: str, p: int, s: int, double: bool = False) -> str:
    src = f"CAST({x} AS VARCHAR)" if double else x
    return f"TRY_CAST({src} AS DECIMAL({p},{s}))"


SQL["cast_int"] = (f"SELECT l_orderkey, l_linenumber, {_to_int('l_quantity')} AS l_quantity, "
                   f"{_to_int('amount_e5')} AS amount_e5, CAST(line_or_null AS INTEGER) AS line_or_null FROM {_LI_NUM}")
SQL["cast_long"] = (f"SELECT l_orderkey, l_linenumber, {_to_int('l_extendedprice', 'BIGINT')} AS l_extendedprice, "
                    f"{_to_int('amount_e14', 'BIGINT')} AS amount_e14 FROM {_LI_NUM}")
SQL["cast_decimal"] = (f"SELECT l_orderkey, l_linenumber, {_to_dec('half_price', 10, 2)} AS half_price, "
                       f"{_to_dec('price_dec', 6, 1)} AS price_dec, {_to_dec('l_discount', 3, 2, True)} AS l_discount "
                       f"FROM {_LI_NUM}")
_ODD = _to_dec("odd_double", 10, 2, True)
SQL["cast_infinite"] = (
    f"SELECT l_orderkey, l_linenumber, {_ODD} AS odd_decimal, CASE WHEN odd_double IS NOT NULL AND {_ODD} IS NULL "
    f"THEN (CASE WHEN isnan(odd_double) THEN 'nan' WHEN isinf(odd_double) THEN 'infinite' ELSE 'overflow' END) END "
    f"AS reason FROM {_LI_NUM}")
SQL["cast_float"] = (f"SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS FLOAT) AS l_extendedprice, "
                     f"CAST(line_or_null AS FLOAT) AS line_or_null, l_tax FROM {_LI_NUM}")
SQL["cast_boolean"] = (f"SELECT l_orderkey, l_linenumber, CAST(line_parity AS BOOLEAN) AS line_parity, "
                       f"CAST(line_or_null AS BOOLEAN) AS line_or_null FROM {_LI_NUM}")
SQL["cast_timestamp"] = ("SELECT o_orderkey, o_orderdate, TRY_CAST(CAST(o_orderdate AS VARCHAR) AS TIMESTAMP) "
                         "AS orderdate_text FROM orders")
SQL["cast_string"] = ("SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS orderkey_text, "
                      "CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderstatus, "
                      "CAST(TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(12,2)) AS VARCHAR) AS total_dec FROM orders")
SQL["cast_date_time"] = ("SELECT event_id, CAST(ts AS DATE) AS ts_date, strftime(ts, '%H:%M:%S') AS ts_time "
                         "FROM events")


def _rejects_sql() -> str:
    checks = [("amount_e5", "int", _to_int("amount_e5")), ("amount_e14", "bigint", _to_int("amount_e14", "BIGINT")),
              ("price_dec", "decimal(6,1)", _to_dec("price_dec", 6, 1)),
              ("line_or_null", "int", "CAST(line_or_null AS INTEGER)")]
    return o.union(
        f"SELECT l_orderkey, l_linenumber, '{c}' AS column_name, CAST({c} AS VARCHAR) AS raw_value, "
        f"'{t}' AS target_type, 'overflow' AS reason FROM {_LI_NUM} WHERE {c} IS NOT NULL AND {conv} IS NULL"
        for c, t, conv in checks)


SQL["cast_rejects"] = _rejects_sql()
SQL["cast_reject_summary"] = (f"SELECT column_name, target_type, reason, count(*) AS rejects FROM ({_rejects_sql()}) "
                              f"GROUP BY column_name, target_type, reason")
SQL["apply_type_plan"] = ("SELECT o_orderkey, o_custkey, o_orderstatus, "
                          "TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(12,2)) AS o_totalprice, o_orderdate, "
                          "o_orderpriority FROM orders")

# ---------------------------------------------------------------- partition transforms

_YEAR = "CAST(year({c}) - 1970 AS INTEGER)"
_MONTH = "CAST((year({c}) - 1970) * 12 + month({c}) - 1 AS INTEGER)"
_DAY = "CAST(date_diff('day', DATE '1970-01-01', CAST({c} AS DATE)) AS INTEGER)"
SQL["part_identity"] = ("SELECT o_orderstatus, o_orderpriority, count(*) AS rows FROM orders "
                        "GROUP BY o_orderstatus, o_orderpriority")
SQL["part_year"] = f"SELECT o_orderkey, {_YEAR.format(c='o_orderdate')} AS o_orderdate_year FROM orders"
SQL["part_month"] = f"SELECT o_orderkey, {_MONTH.format(c='o_orderdate')} AS o_orderdate_month FROM orders"
SQL["part_day"] = f"SELECT o_orderkey, {_DAY.format(c='o_orderdate')} AS o_orderdate_day FROM orders"
SQL["part_hour"] = (f"SELECT event_id, CAST({_DAY.format(c='ts')} * 24 + hour(ts) AS INTEGER) AS ts_hour "
                    f"FROM events")
_U = "CAST(TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(12,2)) * 100 AS BIGINT)"
SQL["part_truncate"] = (
    "SELECT o_orderkey, o_orderkey - ((o_orderkey % 1000) + 1000) % 1000 AS o_orderkey_trunc_1000, "
    "substring(o_orderpriority, 1, 3) AS o_orderpriority_trunc_3, "
    f"CAST(CAST({_U} - (({_U} % 50) + 50) % 50 AS DECIMAL(14,2)) * 0.01 AS DECIMAL(12,2)) AS total_dec_trunc_50 "
    "FROM orders")
SQL["part_multi"] = (
    f"SELECT o_orderstatus, {_YEAR.format(c='o_orderdate')} AS o_orderdate_year, "
    "o_orderkey - ((o_orderkey % 5000) + 5000) % 5000 AS o_orderkey_trunc_5000, count(*) AS rows FROM orders "
    "GROUP BY ALL")



def _murmur3_sql(data: str) -> str:
    """murmur3_x86_32 with seed 0 of a list of byte values, by its published definition."""
    mask = 4294967295
    rot = lambda x, r: f"((({x} << {r}) | ({x} >> {32 - r})) & {mask})"
    # one block: ((k * c1) rotated by 15) * c2
    first = f"(k * 3432918353::HUGEINT & {mask})"
    mixed = f"({rot(first, 15)} * 461845907::HUGEINT & {mask})"
    block = f"list_transform(range(0, len({data}) // 4), lambda i: list_transform([{data}[4 * i + 1]::HUGEINT + {data}[4 * i + 2] * 256::HUGEINT " \
            f"+ {data}[4 * i + 3] * 65536::HUGEINT + {data}[4 * i + 4] * 16777216::HUGEINT], lambda k: {mixed})[1])"
    step = f"({rot('xor(a, x)', 13)} * 5 + 3864292196::HUGEINT) & {mask}"
    body = f"list_reduce(list_prepend(0::HUGEINT, {block}), lambda a, x: {step})"
    rest = " + ".join(f"coalesce({data}[len({data}) // 4 * 4 + {j + 1}], 0) * {256 ** j}::HUGEINT" for j in range(3))
    tail = f"list_transform([{rest}], lambda k: {mixed})[1]"
    steps = [f"xor(xor({body}, {tail}), len({data})::HUGEINT)"]
    for shift, factor in ((16, 2246822507), (13, 3266489909), (16, 1)):
        steps.append(f"list_transform([{steps[-1]}], lambda h: xor(h, h >> {shift}) * {factor}::HUGEINT & {mask})[1]")
    return steps[-1]


def _bucket_sql(data: str, value: str, n: int) -> str:
    return f"CASE WHEN {value} IS NOT NULL THEN CAST(({_murmur3_sql(data)} & 2147483647) % {n} AS INTEGER) END"


_LONG_BYTES = "list_transform(range(0, 8), lambda i: ({v} >> (8 * i)::INTEGER) & 255)"
_TEXT_BYTES = "list_transform(range(1, strlen({v}) + 1), lambda i: ascii(substring({v}, i::INTEGER, 1)))"
_BYTES = {"event_id": _LONG_BYTES.format(v="event_id"), "user_id": _LONG_BYTES.format(v="user_id"),
          "ts": _LONG_BYTES.format(v="epoch_us(ts)"), "event_type": _TEXT_BYTES.format(v="event_type")}
_BUCKETS = {"event_id": 16, "user_id": 8, "ts": 4, "event_type": 8}
SQL["part_bucket"] = (
    "SELECT event_id, " + ", ".join(f"{_bucket_sql(f'b_{c}', c, n)} AS {c}_bucket_{n}" for c, n in _BUCKETS.items())
    + " FROM (SELECT *, " + ", ".join(f"{b} AS b_{c}" for c, b in _BYTES.items()) + " FROM events)")

# ---------------------------------------------------------------- sinks

SQL["load_full"] = "SELECT * FROM orders"
SQL["load_named"] = "SELECT * FROM orders"
SQL["load_incremental"] = ("SELECT event_id, ts, user_id, event_type, value, "
                           "CASE WHEN ts <= TIMESTAMP '2024-01-15 00:00:00' THEN props END AS props FROM events")
SQL["load_merge"] = ("SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01 00:00:00' "
                     "THEN 'U' ELSE o_orderstatus END AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority "
                     "FROM orders")
SQL["load_concurrent"] = "SELECT * FROM orders"
SQL["scan_as_of_version"] = "SELECT * FROM events WHERE ts <= TIMESTAMP '2024-01-20 00:00:00'"
SQL["scan_changes"] = "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-10 00:00:00' OR ts IS NULL"
SQL["file_compaction"] = "SELECT *, CAST(1 AS BIGINT) AS files FROM events"
SQL["load_rejects"] = _rejects_sql()
SQL["load_merge_partitions"] = (
    f"SELECT * REPLACE (CASE WHEN year(o_orderdate) = 1997 THEN 'U' ELSE o_orderstatus END AS o_orderstatus), "
    f"{_YEAR.format(c='o_orderdate')} AS o_orderdate_year FROM orders UNION ALL "
    f"SELECT * REPLACE (-o_orderkey - 1 AS o_orderkey), {_YEAR.format(c='o_orderdate')} FROM orders WHERE year(o_orderdate) = 1996")
SQL["load_partitioned"] = (f"SELECT {_YEAR.format(c='l_shipdate')} AS l_shipdate_year, l_returnflag, "
                           "count(*) AS rows FROM lineitem GROUP BY ALL")
SQL["load_summary"] = (f"SELECT 'full' AS mode, (SELECT count(*) FROM lineitem) AS rows_written, "
                       f"(SELECT count(*) FROM ({_rejects_sql()})) AS rejected_values")

# ---------------------------------------------------------------- metadata report

_REPORT_KEYS = {"orders": ["o_orderkey"], "customer": ["c_custkey"], "part": ["p_partkey"],
                "lineitem": ["l_orderkey", "l_linenumber"]}
_MAPPED = {"string": "string", "timestamp_ntz": "timestamp", "bigint": "long", "int": "integer",
           "double": "double"}

_COUNTERS = "total_values, null_values, int_values, long_values, decimal_values, max_precision, max_scale"


def _report_sql(t: str) -> str:
    num = o.numeric_cols(t)
    names = {n for n, _, _ in num}
    prof = f"SELECT column_name, {o.recommend_sql()} AS rec, {_COUNTERS} FROM ({o.profile_sql(t, t, num)})"
    key = _REPORT_KEYS[t]
    pk = (f"SELECT CASE WHEN is_key THEN key_columns END AS primary_key FROM ({_check_key_sql(t, key)})")
    cols = []
    for pos, (n, typ) in enumerate(o.SCHEMAS[t], start=1):
        cls, prec = o.TYPE_CLASS.get(typ, ("OTHER", 0))
        mapped = "NULL" if n in names else f"'{_MAPPED[typ]}'"
        cols.append(f"SELECT '{n}' AS column_name, {pos} AS position, '{typ}' AS data_type, '{cls}' AS type_class, "
                    f"{prec} AS precision, 0 AS scale, true AS nullable, {mapped} AS mapped")
    return (f"SELECT CAST(NULL AS VARCHAR) AS schema_name, '{t}' AS table_name, "
            f"(SELECT count(*) FROM {t}) AS row_count, c.column_name, c.position, c.data_type, c.type_class, "
            f"c.precision, c.scale, c.nullable, coalesce(p.rec, c.mapped) AS recommended_type, "
            f"{', '.join(f'p.{c}' for c in _COUNTERS.split(', '))}, "
            f"(SELECT primary_key FROM ({pk})) AS primary_key "
            f"FROM ({o.union(cols)}) c LEFT JOIN ({prof}) p ON c.column_name = p.column_name")


SQL["metadata_report"] = o.union(_report_sql(t) for t in _REPORT_KEYS)

# ---------------------------------------------------------------- streaming

SQL["stream_load"] = "SELECT * FROM events"
SQL["stream_profile"] = o.profile_sql("events", "events", o.numeric_cols("events"))
