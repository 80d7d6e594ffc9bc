"""One registered query per operator, over the whole test tables.

Copies with planted changes are derived from the tables by fixed rules, so each
query's work grows with its tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyferry.functions import predicates as P
from tallyferry.functions import scalars as S
from tallyferry.functions.text import quote_json_cells as quote_cells
from tallyferry.functions.text import scrub_nul as scrub
from tallyferry.operators import alignment as A
from tallyferry.operators import checksum as K
from tallyferry.operators import chunking as C
from tallyferry.operators import columns as L
from tallyferry.operators import diffs as D
from tallyferry.operators import digest_tree as G
from tallyferry.operators import maintain as M
from tallyferry.operators import ordering as O
from tallyferry.operators import reconcile as R
from tallyferry.operators import select as X
from tallyferry.operators import sizing as Z
from tallyferry.operators import versions as V
from tallyferry.plans import backfill as B
from tallyferry.plans.export import export_table
from tallyferry.plans.imports import import_table
from tallyferry.plans.oracle_text import (
    CLASSES, checksum_rows, chunk_cuts, digest_sum, row_bytes, table_bytes,
)
from tallyferry.plans.registry import query
from tallyferry.session import materialise, scratch_path
from tallyferry.sources import delimited as T
from tallyferry.sources import footers as N
from tallyferry.sources import traced as E
from tallyferry.sources.tables import read_parquet_table
from tallyferry.specs import Settings, TableSpec, Window
from tallyferry.streaming.file_batches import load_in_batches

PLAIN = Settings(compression=None)
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
ORDERS = TableSpec("orders", "o_orderkey", "o_orderdate", ("o_orderkey",))
EVENTS = TableSpec("events", "event_id", "ts", ("event_id",))
LINES = TableSpec("lineitem", "l_orderkey", "l_shipdate")
YEAR = Window("1996-01-01 00:00:00", "1997-01-01 00:00:00")


def _read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_parquet_table(spark, sf, name)


def _union(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# --- selection ---------------------------------------------------------------


@query("""
select o_orderkey, o_totalprice, o_orderdate from orders where o_orderstatus = 'F'
order by o_orderkey desc limit 1000
""")
def scan_select(spark, sf):
    return X.scan_select(
        _read(spark, sf, "orders"), ["o_orderkey", "o_totalprice", "o_orderdate"],
        F.col("o_orderstatus") == "F", "o_orderkey", 1000,
    )


@query("select * from orders order by o_orderkey desc")
def sort_desc(spark, sf):
    return X.sort_desc(_read(spark, sf, "orders"), "o_orderkey")


@query("""
select l_orderkey, l_linenumber, l_shipdate, l_extendedprice from lineitem
where l_shipdate >= timestamp '1996-01-01' and l_shipdate < timestamp '1997-01-01'
""")
def date_window(spark, sf):
    lines = _read(spark, sf, "lineitem")
    return lines.where(P.date_window(lines, "l_shipdate", YEAR)).select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice"
    )


@query("""
select 'from' as bound, event_id, ts from events where ts >= timestamp '2024-01-10'
union all
select 'to' as bound, event_id, ts from events where ts < timestamp '2024-01-10'
""")
def date_window_open(spark, sf):
    events = _read(spark, sf, "events")
    since, until = Window(start="2024-01-10 00:00:00"), Window(end="2024-01-10 00:00:00")
    return _union(
        events.where(P.date_window(events, "ts", w)).select(F.lit(b).alias("bound"), "event_id", "ts")
        for b, w in (("from", since), ("to", until))
    )


@query("""
select o_orderkey, o_orderstatus, o_totalprice from orders
where o_orderkey >= 1000 and o_orderkey < 9000 and o_orderstatus <> 'P'
""")
def key_range(spark, sf):
    orders = _read(spark, sf, "orders")
    wanted = P.key_range(orders, "o_orderkey", 1000, 9000, F.col("o_orderstatus") != "P")
    return orders.where(wanted).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("select max(o_orderkey) as max_key from orders")
def max_key(spark, sf):
    return X.max_key(_read(spark, sf, "orders"), "o_orderkey")


@query("""
with r as (select rank() over (order by l_orderkey desc) as ranking, * from lineitem)
select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice from r where ranking <= 500
""")
def latest_sample(spark, sf):
    return X.latest_sample(_read(spark, sf, "lineitem"), "l_orderkey", 500).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"
    )


@query("""
with e as (
  select rank() over (order by event_id desc) as ranking, event_id from events
  where ts > timestamp '2024-01-05' and event_id is not null),
l as (
  select rank() over (order by l_orderkey desc) as ranking, l_orderkey from lineitem
  where l_shipdate > timestamp '1996-06-01' and l_orderkey is not null)
select 'events' as table_name,
       coalesce((select min(event_id) from e where ranking = 501), (select min(event_id) from events)) as threshold
union all
select 'lineitem',
       coalesce((select min(l_orderkey) from l where ranking = 51), (select min(l_orderkey) from lineitem))
""")
def sample_threshold(spark, sf):
    cases = (("events", "event_id", 500, "ts", "2024-01-05"),
             ("lineitem", "l_orderkey", 50, "l_shipdate", "1996-06-01"))
    return _union(
        X.sample_threshold(df, key, n, date, P.typed_literal(df, date, floor)).select(
            F.lit(name).alias("table_name"), "threshold"
        )
        for name, key, n, date, floor in cases
        for df in [_read(spark, sf, name)]
    )


@query("""
with e as (select rank() over (order by event_id desc) as ranking, event_id from events),
l as (select rank() over (order by l_orderkey desc) as ranking, l_orderkey from lineitem)
select 'events' as table_name, (select max(event_id) from e where ranking = 500) as threshold
union all
select 'lineitem 50', (select max(l_orderkey) from l where ranking = 50)
union all
select 'lineitem 55', (select max(l_orderkey) from l where ranking = 55)
""")
def sample_threshold_full(spark, sf):
    cases = (("events", "events", "event_id", 500), ("lineitem 50", "lineitem", "l_orderkey", 50),
             ("lineitem 55", "lineitem", "l_orderkey", 55))
    return _union(
        X.sample_threshold_full(_read(spark, sf, table), key, n).select(
            F.lit(label).alias("table_name"), "threshold"
        )
        for label, table, key, n in cases
    )


@query("""
select min(ts) as date_floor from (select ts from events order by event_id desc limit 1500)
""")
def sample_date_floor(spark, sf):
    return X.sample_date_floor(_read(spark, sf, "events"), "event_id", "ts", 500)


@query("""
with c as (
  select 'high price' as case_name, 1 as priority, max(o_orderkey) as v from orders where o_totalprice > 1000
  union all select 'high price', 2, min(o_orderkey) from orders
  union all select 'no such status', 1, max(o_orderkey) from orders where o_orderstatus = '?'
  union all select 'no such status', 2, min(o_orderkey) from orders)
select case_name, arg_min(v, priority) as order_key from c where v is not null group by case_name
""")
def fallback_scalar(spark, sf):
    orders = _read(spark, sf, "orders")
    second = orders.agg(F.min("o_orderkey").alias("low"))
    cases = (("high price", F.col("o_totalprice") > 1000), ("no such status", F.col("o_orderstatus") == "?"))
    return _union(
        X.fallback_scalar(
            orders.where(condition).agg(F.max("o_orderkey").alias("order_key")), "order_key", second, "low"
        ).select(F.lit(name).alias("case_name"), "order_key")
        for name, condition in cases
    )


# --- columns -----------------------------------------------------------------

_LINE_TYPES = (
    ("l_orderkey", "bigint", "number"), ("l_partkey", "bigint", "number"),
    ("l_suppkey", "bigint", "number"), ("l_linenumber", "int", "number"),
    ("l_quantity", "double", "float"), ("l_extendedprice", "double", "float"),
    ("l_discount", "double", "float"), ("l_tax", "double", "float"),
    ("l_returnflag", "string", "string"), ("l_linestatus", "string", "string"),
    ("l_shipdate", "timestamp_ntz", "temporal"),
)


@query("\nunion all\n".join(
    f"select {i} as position, '{c}' as column_name, '{t}' as data_type, '{k}' as checksum_class, "
    f"count(*) as row_count, count({c}) as non_null_rows from lineitem"
    for i, (c, t, k) in enumerate(_LINE_TYPES, start=1)
))
def list_columns(spark, sf):
    return L.list_columns(_read(spark, sf, "lineitem"))


@query("\nunion all\n".join(
    f"select {i} as position, '{c}' as column_name, '{t}' as data_type, '{k}' as checksum_class, "
    f"count(*) as row_count, count({c}) as non_null_rows, "
    f"{'max(' + c + ')' if t in ('bigint', 'int') else 'null'} as largest from lineitem"
    for i, (c, t, k) in enumerate(_LINE_TYPES, start=1)
))
def footer_columns(spark, sf):
    """The columns of lineitem, with the largest whole numbers, from the file's footer."""
    path = f"{sf.rstrip('/')}/lineitem.parquet"
    whole = N.footer_facts(spark, path).join(N.list_columns_by_footers(spark, path).select("column_name", "checksum_class"), "column_name")
    largest = whole.where("checksum_class = 'number'").select("column_name", F.col("high").alias("largest"))
    return N.list_columns_by_footers(spark, path).join(largest, "column_name", "left").select(
        "position", "column_name", "data_type", "checksum_class", "row_count", "non_null_rows", "largest"
    )


@query("\nunion all\n".join(f"select '{t}' as table_name, count(*) as row_count from {t}" for t in TABLES))
def footer_counts(spark, sf):
    """Rows of every table, by its footers."""
    return _union(N.table_counts_by_footers(spark, f"{sf.rstrip('/')}/{t}.parquet", t) for t in TABLES)


@query("select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority as priority from orders")
def normalize_columns(spark, sf):
    shouted = L.shout_columns(_read(spark, sf, "orders"))
    return L.normalize_columns(shouted, {"o_orderpriority": "priority"})


_SCHEMA_DIFF = """
with c as (select count(o_orderkey) k, count(o_custkey) cu, count(o_orderstatus) s, count(o_totalprice) p,
  count(o_orderdate) d, count(o_orderpriority) r,
  count(case when o_orderkey % 10 <> 0 then o_orderdate end) dd from orders)
select 'o_orderkey' as column_name, 'bigint' as source_type, 'bigint' as target_type,
       k as source_non_null, k as target_non_null, 'same' as status from c
union all select 'o_custkey', 'bigint', null, cu, null, 'source_only' from c
union all select 'o_orderstatus', 'string', 'string', s, s, 'same' from c
union all select 'o_totalprice', 'double', 'decimal(15,2)', p, p, 'type_differs' from c
union all select 'o_orderdate', 'timestamp_ntz', 'timestamp_ntz', d, dd, 'same' from c
union all select 'o_orderpriority', 'string', null, r, null, 'source_only' from c
union all select 'o_client', null, 'bigint', null, cu, 'target_only' from c
"""


def _other_orders(orders):
    """A copy of orders with other names, types and NULLs."""
    return orders.select(
        F.col("o_totalprice").cast("decimal(15,2)").alias("O_TOTALPRICE"),
        F.col("o_orderkey").alias("O_ORDERKEY"), F.col("o_custkey").alias("O_CLIENT"),
        "o_orderstatus", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderdate")).alias("o_orderdate"),
    )


@query(_SCHEMA_DIFF)
def schema_diff(spark, sf):
    orders = _read(spark, sf, "orders")
    return L.schema_diff(orders, _other_orders(orders))


@query(_SCHEMA_DIFF)
def footer_schema_diff(spark, sf):
    """The same of two stored tables, by their footers."""
    path = scratch_path(spark, "other-orders")
    _other_orders(_read(spark, sf, "orders")).write.parquet(path)
    return N.schema_diff_by_footers(spark, f"{sf.rstrip('/')}/orders.parquet", path)


@query("""
select 'embeddings' as table_name, cast(1 as bigint) as unchecked_columns, count(*) as row_count,
       count(embedding) as unchecked_rows from embeddings
union all select 'orders', 0, count(*), 0 from orders
union all select 'events', 1, count(*), count(value) from events
""")
def unchecked_columns(spark, sf):
    flagged = _read(spark, sf, "events").withColumn("value", F.col("value") > 10)
    return _union([
        L.unchecked_columns(_read(spark, sf, "embeddings"), "embeddings"),
        L.unchecked_columns(_read(spark, sf, "orders"), "orders"),
        L.unchecked_columns(flagged, "events"),
    ])


# --- order and chunks --------------------------------------------------------


@query("""
select o_orderkey, o_orderdate, row_number() over (order by o_orderdate, o_orderkey) as row_num from orders
""")
def global_row_number(spark, sf):
    orders = _read(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return O.number_rows(orders, ["o_orderdate", "o_orderkey"])


@query(f"""
with {chunk_cuts("lineitem", "l_orderkey", 7000)}
select chunk_id, row_num, low_key, high_key from ranges
""")
def chunk_boundaries(spark, sf):
    return C.chunk_boundaries(_read(spark, sf, "lineitem"), "l_orderkey", 7000)


@query(f"""
with {chunk_cuts("orders", "o_orderdate", 1700)}
select chunk_id, row_num, low_key, high_key from ranges
""")
def chunk_boundaries_by_date(spark, sf):
    return C.chunk_boundaries(_read(spark, sf, "orders"), "o_orderdate", 1700)


@query(f"""
with {chunk_cuts("lineitem", "l_orderkey", 7000)}
select l.l_orderkey, l.l_linenumber, l.l_partkey, r.chunk_id
from lineitem l join ranges r
  on (r.low_key is null or l.l_orderkey >= r.low_key) and (r.high_key is null or l.l_orderkey < r.high_key)
""")
def chunk_assign(spark, sf):
    lines = _read(spark, sf, "lineitem")
    plan = C.plan_chunks(lines, "l_orderkey", 7000)
    return C.assign_chunks(lines.select("l_orderkey", "l_linenumber", "l_partkey"), plan)


@query(f"""
with keyed as (select event_id, case when user_id % 40 = 0 then null else ts end as ts from events),
{chunk_cuts("keyed", "ts", 90)}
select k.event_id, k.ts, case when k.ts is null then -1 else r.chunk_id end as chunk_id
from keyed k left join ranges r
  on (r.low_key is null or k.ts >= r.low_key) and (r.high_key is null or k.ts < r.high_key)
  and k.ts is not null
""")
def chunk_assign_fine(spark, sf):
    stamped = F.when(F.col("user_id") % 40 != 0, F.col("ts")).alias("ts")
    keyed = _read(spark, sf, "events").select("event_id", stamped)
    return C.assign_chunks(keyed, C.plan_chunks(keyed, "ts", 90))


# --- sizes and aggregates ----------------------------------------------------


@query("\nunion all\n".join(f"select '{t}' as table_name, count(*) as row_count from {t}" for t in TABLES))
def table_counts(spark, sf):
    return _union(K.table_counts(_read(spark, sf, t), t) for t in TABLES)


_SIZED = ("lineitem", "orders", "events", "part", "documents")


@query("\nunion all\n".join(
    f"select '{t}' as table_name, count(*) as row_count, cast(sum({table_bytes(t)}) as bigint) as bytes, "
    f"round(cast(sum({table_bytes(t)}) as double) / (1024.0 * 1024.0), -2) as size_mb from {t}"
    for t in _SIZED
))
def table_size_mb(spark, sf):
    return _union(Z.table_size(_read(spark, sf, t), t) for t in _SIZED)


@query("with sizes as (" + "\nunion all\n".join(
    f"select '{t}' as table_name, round(sum({table_bytes(t)}) / (1024.0 * 1024.0), 1) as used_mb from {t}"
    for t in _SIZED) + "), counts as (" + "\nunion all\n".join(
    f"select '{t}' as table_name, count(*) as row_count from {t}" for t in _SIZED) + """)
select table_name, used_mb, row_count,
       cast(coalesce(round(1.0 / nullif(used_mb / row_count, 0), -3), 0) as bigint) as chunk_rows
from sizes join counts using (table_name)
""")
def rows_per_chunk(spark, sf):
    sizes = _union(Z.table_size(_read(spark, sf, t), t) for t in _SIZED)
    return Z.rows_per_chunk(sizes, 1.0)


@query("""
with s as (select l_returnflag, l_suppkey, sum(l_quantity) as total from lineitem group by all)
select l_returnflag, max(total) as largest, count(*) as segments from s group by l_returnflag
""")
def two_level_agg(spark, sf):
    lines = _read(spark, sf, "lineitem")
    return Z.two_level_max(lines, ["l_returnflag"], ["l_suppkey"], F.col("l_quantity"))


@query(f"""
select c_mktsegment, cast(sum({table_bytes("orders")}) as bigint) as bytes, count(*) as row_count,
       round(cast(sum({table_bytes("orders")}) as double) / (1024.0 * 1024.0), 1) as size_mb
from orders join customer on o_custkey = c_custkey and c_acctbal > 0
group by c_mktsegment
""")
def size_join(spark, sf):
    segments = _read(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return Z.size_by_segment(
        _read(spark, sf, "orders"), "o_custkey", segments, "c_custkey", "c_mktsegment",
        F.col("c_acctbal") > 0,
    )


_PROFILED = (("lineitem", "l_shipdate"), ("orders", "o_orderdate"), ("events", "ts"), ("documents", None))
_DECIDE = Settings(chunking=True, whole_table_mb=1, windowed_table_mb=4, window_weeks=150)


def _weeks_sql(column: str | None) -> str:
    if column is None:
        return "cast(-1 as double)"
    return f"epoch_us(max({column})) / 604800e6 - epoch_us(min({column})) / 604800e6"


@query("with p as (" + "\nunion all\n".join(
    f"select '{t}' as table_name, round(sum({table_bytes(t)}) / (1024.0 * 1024.0), 1) as size_mb, "
    f"{_weeks_sql(d)} as weeks from {t}" for t, d in _PROFILED) + """)
select table_name, size_mb, cast(round(weeks, 3) as double) as weeks,
       (size_mb < 4 and weeks > 0 and weeks < 150) or size_mb < 1 as in_one_piece from p
""")
def chunk_decision(spark, sf):
    def profile(name: str, date_col: str | None) -> DataFrame:
        df = _read(spark, sf, name)
        span = S.weeks_between(F.min(date_col), F.max(date_col)) if date_col else F.lit(-1.0)
        return df.agg(
            S.megabytes(F.sum(Z.row_bytes(df)), 1).alias("size_mb"), span.cast("double").alias("weeks")
        ).select(F.lit(name).alias("table_name"), "size_mb", "weeks")

    decided = C.chunk_decision(_union(profile(t, d) for t, d in _PROFILED), _DECIDE)
    return decided.withColumn("weeks", F.round("weeks", 3))


# --- checksums ---------------------------------------------------------------

_CHECKED = ("table_name", "checksum_class", "column_count", "value", "row_count")


def _checksum(spark, sf, kind, tables):
    return _union(
        K.checksums(_read(spark, sf, t), t, classes=[kind]) for t in tables
    ).where(F.col("checksum_class") == kind).select(*_CHECKED)


def _checksum_sql(kind: str, tables) -> str:
    return "\nunion all\n".join(checksum_rows(t, [kind]) for t in tables)


@query(_checksum_sql("string", ("lineitem", "orders", "events", "part", "documents", "embeddings")))
def checksum_string(spark, sf):
    return _checksum(
        spark, sf, "string", ("lineitem", "orders", "events", "part", "documents", "embeddings")
    )


@query(_checksum_sql("number", ("lineitem", "orders", "events", "part", "documents", "embeddings")))
def checksum_number(spark, sf):
    return _checksum(
        spark, sf, "number", ("lineitem", "orders", "events", "part", "documents", "embeddings")
    )


@query(_checksum_sql("float", ("lineitem", "orders", "events", "part")))
def checksum_float(spark, sf):
    return _checksum(spark, sf, "float", ("lineitem", "orders", "events", "part"))


@query(_checksum_sql("temporal", ("lineitem", "orders", "events", "part")))
def checksum_temporal(spark, sf):
    return _checksum(spark, sf, "temporal", ("lineitem", "orders", "events", "part"))


@query("""
select o_orderpriority, 'temporal' as checksum_class, cast(2 as bigint) as column_count,
       cast(count(distinct cast(o_orderdate as date)) + count(distinct o_orderdate + interval (o_orderkey % 5) hour) as double) as value,
       count(*) as row_count
from orders group by o_orderpriority
""")
def checksum_dates(spark, sf):
    """Distinct days by bitmaps and distinct times by values, per priority."""
    orders = _read(spark, sf, "orders").select(
        "o_orderpriority", F.col("o_orderdate").cast("date").alias("day"),
        F.expr("o_orderdate + make_dt_interval(0, cast(o_orderkey % 5 as int))").alias("stamp"),
    )
    return K.checksums(orders, "orders", by=["o_orderpriority"], classes=["temporal"]).select(
        "o_orderpriority", "checksum_class", "column_count", "value", "row_count"
    )


_WINDOWED = "(select * from lineitem where l_shipdate >= timestamp '1996-01-01' and l_shipdate < timestamp '1997-01-01')"


@query(checksum_rows("lineitem", relation=_WINDOWED))
def checksum_windowed(spark, sf):
    lines = _read(spark, sf, "lineitem")
    window = P.date_window(lines, "l_shipdate", YEAR)
    return K.checksums(lines, "lineitem", window).select(*_CHECKED)


@query(f"select 'orders' as table_name, count(*) as row_count, cast({digest_sum(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority'])} as varchar) as fingerprint from orders")
def table_fingerprint(spark, sf):
    printed = K.table_fingerprint(_read(spark, sf, "orders"), "orders", "md5")
    return printed.withColumn("fingerprint", F.col("fingerprint").cast("string"))


# --- files -------------------------------------------------------------------


@query("select * from orders")
def export_tab_roundtrip(spark, sf):
    orders, path = _read(spark, sf, "orders"), scratch_path(spark, "tab")
    T.write_delimited(orders, path, PLAIN)
    return T.load_delimited(spark, path, orders.schema, PLAIN).good()


@query("select * from events")
def export_gzip_roundtrip(spark, sf):
    events, path = _read(spark, sf, "events"), scratch_path(spark, "gzip")
    T.write_delimited(events, path, Settings())
    return T.load_delimited(spark, path, events.schema, Settings()).good()


def _chunked_orders(spark, sf) -> str:
    orders, path = _read(spark, sf, "orders"), scratch_path(spark, "chunks")
    plan = C.plan_chunks(orders, "o_orderdate", 1700)
    chunked = C.spread_by_chunk(C.assign_chunks(orders, plan), plan)
    T.write_delimited(chunked, path, Settings(), chunked=True)
    return path


_ORDERS_IN_CHUNKS = f"""
with {chunk_cuts("orders", "o_orderdate", 1700)},
placed as (select o.*, r.chunk_id from orders o join ranges r
  on (r.low_key is null or o.o_orderdate >= r.low_key) and (r.high_key is null or o.o_orderdate < r.high_key))
"""


@query(_ORDERS_IN_CHUNKS + """
select chunk_id, count(*) as row_count, min(o_orderdate) as first_date, max(o_orderdate) as last_date
from placed group by chunk_id
""")
def export_chunk_layout(spark, sf):
    path = _chunked_orders(spark, sf)
    orders = _read(spark, sf, "orders")
    text = T.read_delimited(spark, path, Settings())
    typed = text.select(
        T.chunk_of(F.col("_metadata.file_path")).alias("chunk_id"),
        T.convert(F.col("o_orderdate"), orders.schema["o_orderdate"].dataType).alias("o_orderdate"),
    )
    return typed.groupBy("chunk_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("o_orderdate").alias("first_date"),
        F.max("o_orderdate").alias("last_date"),
    )


@query(_ORDERS_IN_CHUNKS + "select chunk_id, count(*) as data_lines from placed group by chunk_id")
def export_line_counts(spark, sf):
    counts = T.line_counts(spark, _chunked_orders(spark, sf))
    # Each file carries one header line.
    return counts.groupBy(T.chunk_of(F.col("file")).alias("chunk_id")).agg(
        F.sum(F.col("lines") - 1).alias("data_lines")
    )


@query("select * from orders")
def load_by_header(spark, sf):
    orders, path = _read(spark, sf, "orders"), scratch_path(spark, "turned")
    turned = L.shout_columns(orders.select(*reversed(orders.columns)))
    T.write_delimited(turned, path, PLAIN)
    return T.load_delimited(spark, path, orders.schema, PLAIN).good()


def _spoiled_orders(spark, sf) -> T.Loaded:
    orders, path = _read(spark, sf, "orders"), scratch_path(spark, "spoiled")
    _spoil(orders, path)
    return T.load_delimited(spark, path, orders.schema, PLAIN)


def _spoil(orders, path, part=None) -> None:
    """Orders as raw lines: key % 97 = 0 has a field too many, key % 89 = 0 no number as price.

    With ``part``, one file for each of its values, in key order.
    """
    text = T.as_text(orders)
    price = F.when(F.col("o_orderkey").cast("bigint") % 89 == 0, "n/a").otherwise(F.col("o_totalprice"))
    cells = text.withColumn("o_totalprice", price)
    line = F.concat_ws("\t", *orders.columns)
    spoiled = F.when(F.col("o_orderkey").cast("bigint") % 97 == 0, F.concat(line, F.lit("\textra")))
    header = "\t".join(orders.columns)
    lines = cells.select(F.coalesce(spoiled, line).alias(header))
    if part is not None:
        keyed = cells.select(F.coalesce(spoiled, line).alias(header), part.alias("part"), F.col("o_orderkey").cast("bigint").alias("at"))
        lines = keyed.repartition("part").sortWithinPartitions("part", "at").drop("at")
    writer = lines.write.partitionBy("part") if part is not None else lines.write
    writer.options(
        header="true", sep="\u0001", quote="\u0002", lineSep="\n",
        ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
    ).csv(path)


@query("\nunion all\n".join(
    f"select '{t}' as table_name, cast({i} as bigint) as id, {c} as content from {t}"
    for t, i, c in (("documents", "doc_id", "nullif(text, '')"), ("pages", "page_id", "nullif(html, '')"),
                    ("conversations", "conv_id * 10000 + turn", "nullif(text, '')"))
))
def export_text_roundtrip(spark, sf):
    """Texts with line breaks, tabs and quotes through files, one line a row."""

    def moved(name: str, number: str, content: str) -> DataFrame:
        rows, path = _read(spark, sf, name), scratch_path(spark, "texts")
        T.write_delimited(rows, path, Settings())
        good = T.load_delimited(spark, path, rows.schema, Settings()).good()
        return good.selectExpr(f"'{name}' as table_name", f"cast({number} as bigint) as id", f"{content} as content")

    return _union([
        moved("documents", "doc_id", "text"), moved("pages", "page_id", "html"),
        moved("conversations", "conv_id * 10000 + turn", "text"),
    ])


@query("select * from orders where o_orderkey % 97 <> 0 and o_orderkey % 89 <> 0")
def load_bad_rows(spark, sf):
    return _spoiled_orders(spark, sf).good()


@query("""
select case when o_orderkey % 97 = 0 then 'malformed line' else 'not of its type: o_totalprice' end as bad_reason,
       count(*) as bad_rows
from orders where o_orderkey % 97 = 0 or o_orderkey % 89 = 0 group by 1
""")
def load_quarantine(spark, sf):
    bad = _spoiled_orders(spark, sf).bad()
    return bad.groupBy("bad_reason").agg(F.count("bad_line").alias("bad_rows"))


@query("""
select case when o_orderkey % 97 = 0 then 'malformed line' else 'not of its type: o_totalprice' end as bad_reason,
       cast(part as bigint) as part, cast(line as bigint) as line, o_orderkey
from (select *, o_orderkey % 8 as part, 1 + row_number() over (partition by o_orderkey % 8 order by o_orderkey) as line from orders)
where o_orderkey % 97 = 0 or o_orderkey % 89 = 0
""")
def load_traced_rows(spark, sf):
    """The spoiled lines of eight files, each by its file and line."""
    orders, path = _read(spark, sf, "orders"), scratch_path(spark, "spoiled")
    _spoil(orders, path, F.col("o_orderkey").cast("bigint") % 8)
    bad = E.load_traced(spark, path, orders.schema, PLAIN).bad()
    key = F.split("bad_line", "\t")[orders.columns.index("o_orderkey")].cast(orders.schema["o_orderkey"].dataType)
    part = F.regexp_extract("bad_file", r"part=(\d+)", 1).cast("bigint")
    return bad.select("bad_reason", part.alias("part"), F.col("bad_line_number").alias("line"), key.alias("o_orderkey"))


@query("select * from orders")
def load_file_batches(spark, sf):
    orders = _read(spark, sf, "orders")
    target = scratch_path(spark, "batches")
    load_in_batches(
        spark, _chunked_orders(spark, sf), orders.columns, orders.schema, target,
        Settings(files_per_batch=5),
    )
    return spark.read.schema(orders.schema).parquet(target).select(*orders.columns)


@query("""
select o_orderkey, case when o_orderkey % 97 = 0 then null else o_totalprice end as o_totalprice, o_orderdate,
       case when o_orderkey % 97 = 0 then 'not of its type: o_totalprice' end as bad_reason
from orders
""")
def conform_types(spark, sf):
    orders = _read(spark, sf, "orders")
    text = T.as_text(orders).withColumn(
        "o_totalprice",
        F.when(F.col("o_orderkey").cast("bigint") % 97 == 0, "12,5x").otherwise(F.col("o_totalprice")),
    )
    return T.conform(text, orders.schema).rows.select(
        "o_orderkey", "o_totalprice", "o_orderdate", "bad_reason"
    )


@query("select * from orders")
def append_target(spark, sf):
    orders, path = _read(spark, sf, "orders"), scratch_path(spark, "target")
    done = F.col("o_orderstatus") == "F"
    M.append_path(orders.where(done), path, orders.schema)
    M.append_path(
        M.delete_rows(orders, done).select(*reversed(orders.columns)), path, orders.schema
    )
    return M.read_target(spark, path, orders.schema)


@query("select * from events where ts < timestamp '2024-01-12' union all select * from events where ts >= timestamp '2024-01-08'")
def append_by_day(spark, sf):
    events, path = _read(spark, sf, "events"), scratch_path(spark, "target")
    M.replace_window(spark, path, events, "ts", Window(end="2024-1-12 00:00:00"))
    M.append_path(events.where("ts >= timestamp_ntz'2024-01-08'"), path, events.schema, "ts")
    return M.read_target(spark, path, events.schema)


@query("select doc_id, replace(text, 'e', '') as text, lang, source, n_chars from documents")
def scrub_nul(spark, sf):
    planted = _read(spark, sf, "documents").withColumn("text", F.translate("text", "e", "\u0000"))
    return scrub(planted)


@query("""
select event_id, event_type, case when props like '{%}' then '''' || props || '''' else props end as props from events
""")
def quote_json_cells(spark, sf):
    return quote_cells(_read(spark, sf, "events").select("event_id", "event_type", "props"))


# --- target changes ----------------------------------------------------------


@query("""
with o as (select o_orderkey, case when o_orderkey % 50 = 0 then null else o_orderdate end as o_orderdate from orders)
select * from o where not coalesce(o_orderdate >= timestamp '1996-01-01' and o_orderdate < timestamp '1997-01-01', false)
""")
def delete_window(spark, sf):
    dated = F.when(F.col("o_orderkey") % 50 != 0, F.col("o_orderdate")).alias("o_orderdate")
    orders = _read(spark, sf, "orders").select("o_orderkey", dated)
    return M.delete_rows(orders, P.date_window(orders, "o_orderdate", YEAR))


@query("""
select event_id, ts, user_id, event_type,
       case when ts >= timestamp '2024-01-05 06:00:00' and ts < timestamp '2024-01-20' then value else -1.0 end as value,
       props
from events
where not (ts >= timestamp '2024-01-12' and ts < timestamp '2024-01-13')
""")
def replace_window(spark, sf):
    """A target with other values and one day the fresh slice lacks; replaced twice."""
    events, path = _read(spark, sf, "events"), scratch_path(spark, "days")
    M.write_days(events.withColumn("value", F.lit(-1.0)), path, "ts")
    day = P.date_window(events, "ts", Window("2024-01-12 00:00:00", "2024-01-13 00:00:00"))
    fresh = M.delete_rows(events, day)
    window = Window("2024-01-05 06:00:00", "2024-01-20 00:00:00")
    M.replace_window(spark, path, fresh, "ts", window)
    M.replace_window(spark, path, fresh, "ts", window)
    return M.read_target(spark, path, events.schema)


@query("""
select event_id, ts, user_id, event_type,
       case when ts >= timestamp '2024-01-05 06:00:00' and ts < timestamp '2024-01-20' then value else -1.0 end as value,
       props
from events
where not (ts >= timestamp '2024-01-12' and ts < timestamp '2024-01-13')
""")
def replace_window_atomic(spark, sf):
    """The same replacement, each time visible at once; old states are released."""
    events, path = _read(spark, sf, "events"), scratch_path(spark, "versions")
    V.replace_window_at_once(spark, path, events.withColumn("value", F.lit(-1.0)), "ts", Window("2023-01-01 00:00:00"))
    fresh = M.delete_rows(events, P.date_window(events, "ts", Window("2024-01-12 00:00:00", "2024-01-13 00:00:00")))
    for _ in range(2):
        V.replace_window_at_once(spark, path, fresh, "ts", Window("2024-01-05 06:00:00", "2024-01-20 00:00:00"))
    V.release_versions(spark, path)
    return V.read_version(spark, path, events.schema)


@query("select count(*) as rows_before, cast(0 as bigint) as rows_after from orders")
def truncate_target(spark, sf):
    orders, path = _read(spark, sf, "orders"), scratch_path(spark, "emptied")
    M.append_path(orders, path, orders.schema)
    before = M.read_target(spark, path, orders.schema).count()
    M.truncate_path(spark, path, orders.schema)
    left = M.read_target(spark, path, orders.schema)
    return left.agg(F.lit(before).cast("bigint").alias("rows_before"),
                    F.count(F.lit(1)).alias("rows_after"))


# --- reconciliation ----------------------------------------------------------

_ALTERED_SQL = """(select o_orderkey, o_custkey, o_orderstatus,
  case when o_orderkey % 1000 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice,
  o_orderdate, o_orderpriority from orders where o_orderkey % 997 <> 0)"""


def _altered(orders: DataFrame) -> DataFrame:
    """Copy of orders: price + 1 where key % 1000 = 0, rows with key % 997 = 0 missing."""
    price = F.when(F.col("o_orderkey") % 1000 == 0, F.col("o_totalprice") + 1)
    return orders.where(F.col("o_orderkey") % 997 != 0).withColumn(
        "o_totalprice", F.coalesce(price, F.col("o_totalprice"))
    )


def _shown_sql(prefix: str) -> str:
    return (f"case when {prefix}.value is null then null when checksum_class = 'temporal' "
            f"then printf('%.0f', {prefix}.value) else printf('%.2f', {prefix}.value) end")


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query(f"""
with s as ({checksum_rows("orders")} union all {checksum_rows("events")} union all {checksum_rows("embeddings")}),
t as ({checksum_rows("orders", relation=_ALTERED_SQL)} union all {checksum_rows("events")}
  union all {checksum_rows("embeddings")}),
prints as (select (select {digest_sum(_ORDER_COLUMNS)} from orders) as sd, (select count(*) from orders) as sr,
  (select {digest_sum(_ORDER_COLUMNS)} from {_ALTERED_SQL}) as td, (select count(*) from {_ALTERED_SQL}) as tr),
e as (select cast(count(*) as bigint) as n from embeddings)
select table_name, checksum_class,
  case when s.column_count = 0 then 'SUCCESS'
       when s.value is not distinct from t.value and s.row_count = t.row_count then 'SUCCESS' else 'FAILURE' end as status,
  {_shown_sql("s")} as source_value, {_shown_sql("t")} as target_value,
  s.row_count as source_rows, t.row_count as target_rows
from s join t using (table_name, checksum_class)
union all
select 'orders', 'fingerprint', case when sd = td and sr = tr then 'SUCCESS' else 'FAILURE' end,
  cast(sd as varchar), cast(td as varchar), sr, tr from prints
union all
select 'embeddings', 'unchecked', 'WARNING', null, null, n, n from e
""")
def reconcile_report(spark, sf):
    orders, events = _read(spark, sf, "orders"), _read(spark, sf, "events")
    vectors = _read(spark, sf, "embeddings")
    return _union([
        R.reconcile(orders, _altered(orders), "orders", fingerprint="md5"),
        R.reconcile(events, events, "events", fingerprint=None),
        R.reconcile(vectors, vectors, "embeddings", fingerprint=None),
    ]).drop("message")


@query(f"""
with t as {_ALTERED_SQL}
select s.o_orderkey, 'o_totalprice' as column_name, cast(s.o_totalprice as varchar) as source_value,
       cast(t.o_totalprice as varchar) as target_value, 'changed' as kind
from orders s join t using (o_orderkey) where s.o_totalprice <> t.o_totalprice
union all
select o_orderkey, null, null, null, 'source_only' from orders where o_orderkey not in (select o_orderkey from t)
""")
def field_diff(spark, sf):
    orders = _read(spark, sf, "orders")
    return D.field_diff(orders, _altered(orders), ["o_orderkey"])


@query("""
with s as (select * from lineitem where l_linenumber = 1),
o as (select l_orderkey, min(l_extendedprice) as price from s group by l_orderkey),
t as (select l_orderkey, case when l_orderkey between 1000 and 1099 then price + 1 else price end as price from o
      where l_orderkey not between 1300 and 1309)
select l_orderkey, 'price' as column_name, cast(o.price as varchar) as source_value, cast(t.price as varchar) as target_value,
       'changed' as kind from o join t using (l_orderkey) where o.price <> t.price
union all
select l_orderkey, null, null, null, 'source_only' from o where l_orderkey not in (select l_orderkey from t)
""")
def tree_diff(spark, sf):
    """Changes in two short key ranges: the join reads these and their neighbours only."""
    lines = _read(spark, sf, "lineitem").where("l_linenumber = 1")
    source = lines.groupBy("l_orderkey").agg(F.min("l_extendedprice").alias("price"))
    price = F.when(F.col("l_orderkey").between(1000, 1099), F.col("price") + 1).otherwise(F.col("price"))
    target = source.where(~F.col("l_orderkey").between(1300, 1309)).withColumn("price", price)
    return G.tree_diff(source, target, ["l_orderkey"]).lines


@query(f"""
with t as {_ALTERED_SQL},
a as (select * from orders except all select * from t), b as (select * from t except all select * from orders)
select *, 'source' as side, count(*) as copies from a group by all
union all select *, 'target' as side, count(*) as copies from b group by all
""")
def multiset_diff(spark, sf):
    orders = _read(spark, sf, "orders")
    return D.multiset_diff(orders, _altered(orders))


_LINE_ORDER = ", ".join(c for c, _, _ in _LINE_TYPES)


@query(f"""
with s as (select row_number() over (order by {_LINE_ORDER}) as row_num, * from lineitem),
t as (select row_number() over (order by {_LINE_ORDER}) as row_num, *
      from (select * replace (case when l_orderkey % 1000 = 0 then 'X' else l_linestatus end as l_linestatus) from lineitem))
select row_num, 'l_linestatus' as column_name, s.l_linestatus as source_value, t.l_linestatus as target_value,
       'changed' as kind
from s join t using (row_num) where s.l_linestatus is distinct from t.l_linestatus
""")
def positional_diff(spark, sf):
    lines = _read(spark, sf, "lineitem")
    status = F.when(F.col("l_orderkey") % 1000 == 0, "X").otherwise(F.col("l_linestatus"))
    return D.positional_diff(lines, lines.withColumn("l_linestatus", status))


def _moved_lines(lines: DataFrame) -> DataFrame:
    """Copy of lineitem: some rows missing, some with two other cells, some more with new keys."""
    key, part = F.col("l_orderkey"), F.col("l_partkey")
    changed = key % 1000 == 0
    kept = lines.where(~((key % 997 == 0) & (F.col("l_linenumber") == 1)))
    copy = kept.withColumn("l_linestatus", F.when(changed, "X").otherwise(F.col("l_linestatus"))).withColumn(
        "l_partkey", F.when(changed & (F.col("l_linenumber") == 2), part + 1_000_000).otherwise(part)
    )
    more = lines.where(key % 1499 == 0).withColumn("l_orderkey", key + 90_000_000).withColumn("l_partkey", part + 1).withColumn(
        "l_suppkey", F.col("l_suppkey") + 1
    )
    return copy.unionByName(more)


@query("""
with changed as (select l_orderkey, l_linenumber, l_partkey, l_linestatus from lineitem
  where l_orderkey % 1000 = 0 and not (l_orderkey % 997 = 0 and l_linenumber = 1)),
lines as (
  select l_orderkey, l_linenumber, 'l_linestatus' as column_name, l_linestatus as source_value, 'X' as target_value,
         'changed' as kind from changed
  union all
  select l_orderkey, l_linenumber, 'l_partkey', cast(l_partkey as varchar), cast(l_partkey + 1000000 as varchar), 'changed'
  from changed where l_linenumber = 2
  union all
  select l_orderkey, l_linenumber, null, null, null, 'source_only' from lineitem
  where l_orderkey % 997 = 0 and l_linenumber = 1
  union all
  select l_orderkey + 90000000, l_linenumber, null, null, null, 'target_only' from lineitem where l_orderkey % 1499 = 0)
select *, count(*) as copies from lines group by all
""")
def aligned_diff(spark, sf):
    lines = _read(spark, sf, "lineitem")
    return A.aligned_diff(lines, _moved_lines(lines), ["l_orderkey", "l_linenumber"])


_DAILY = "(select *, cast(ts as date) as run_day from events)"
_DAILY_ALTERED = """(select * replace (case when event_id % 4000 = 0 then user_id + 1 else user_id end as user_id),
  cast(ts as date) as run_day from events)"""


@query(f"""
with s as ({checksum_rows("events", relation=_DAILY, by="run_day")}),
t as ({checksum_rows("events", relation=_DAILY_ALTERED, by="run_day")}),
report as (select run_day, table_name, checksum_class,
  case when s.value is not distinct from t.value and s.row_count = t.row_count then 'SUCCESS' else 'FAILURE' end as status
  from s join t using (run_day, table_name, checksum_class))
select run_day, table_name, checksum_class, 'failed check' as problem from report where status = 'FAILURE'
union all
select cast(d as date), null, null, 'no report'
from generate_series(date '2023-12-30', date '2024-02-02', interval 1 day) g(d)
where cast(d as date) not in (select run_day from report)
""")
def failure_scan(spark, sf):
    events = _read(spark, sf, "events")
    user = F.when(F.col("event_id") % 4000 == 0, F.col("user_id") + 1).otherwise(F.col("user_id"))
    reports = materialise(
        B.report_by_day(
            events, events.withColumn("user_id", user), EVENTS, Window("2023-12-30 00:00:00", "2024-02-03 00:00:00")
        ),
        "reports",
    )
    expected = B.day_windows(spark, "2023-12-30", "2024-02-03").withColumnRenamed("from_date", "run_day")
    return R.failure_scan(reports, expected, "run_day")


# --- flows -------------------------------------------------------------------


@query("""
with d as (select cast(g.d as date) as from_date
           from generate_series(date '2023-12-28', date '2024-02-03', interval 1 day) g(d))
select from_date, cast(from_date + interval 1 day as date) as to_date, count(event_id) as row_count
from d left join events on cast(ts as date) = from_date group by 1, 2
""")
def day_windows(spark, sf):
    return B.rows_per_day(_read(spark, sf, "events"), "ts", "2023-12-28", "2024-02-04")


_MARKED = (("orders", "o_orderkey"), ("events", "event_id"), ("lineitem", "l_shipdate"),
           ("customer", "c_custkey"), ("documents", "doc_id"))


@query("\nunion all\n".join(
    f"select '{t}' as table_name, cast(max({c}) as varchar) as last_id from {t}" for t, c in _MARKED
))
def bookmarks(spark, sf):
    return _union(B.bookmark(_read(spark, sf, t), t, c) for t, c in _MARKED)


@query("""
select * from events where ts >= timestamp '2024-01-08' and ts < timestamp '2024-01-22'
""")
def export_job(spark, sf):
    """Window mode with chunking on: files are cut by key, then read back."""
    events, out = _read(spark, sf, "events"), scratch_path(spark, "export")
    settings = Settings(chunking=True, whole_table_mb=0, windowed_table_mb=0, chunk_mb=0.05)
    window = Window("2024-01-08 00:00:00", "2024-01-22 00:00:00")
    done = export_table(events, EVENTS, out, window=window, settings=settings)
    return T.load_delimited(spark, done.path, events.schema, settings).good()


@query("""
with l as (select rank() over (order by l_orderkey desc) as ranking, l_orderkey from lineitem),
b as (select coalesce((select min(l_orderkey) from l where ranking = 501), (select min(l_orderkey) from lineitem)) as low,
             (select max(l_orderkey) from lineitem) as high)
select lineitem.* from lineitem, b where l_orderkey >= low and l_orderkey < high
""")
def export_sample(spark, sf):
    """Sample mode: the newest 500 rows by key, the newest key left out."""
    lines, out = _read(spark, sf, "lineitem"), scratch_path(spark, "sample")
    done = export_table(lines, LINES, out, sample_size=500)
    return T.load_delimited(spark, done.path, lines.schema, Settings()).good()


@query("""
with f as (select min(ts) as floor from (select ts from events where event_id is not null order by event_id desc limit 900)),
r as (select rank() over (order by event_id desc) as ranking, event_id from events, f where ts > floor),
b as (select coalesce((select min(event_id) from r where ranking = 301), (select min(event_id) from events)) as low,
             (select max(event_id) from events) as high)
select events.* from events, b where event_id >= low and event_id < high
""")
def export_sample_floor(spark, sf):
    """Sample mode with a date floor: ranks count only rows dated after the oldest of the 900 newest keys."""
    events, out = _read(spark, sf, "events"), scratch_path(spark, "floor")
    spec = TableSpec("events", "event_id", "ts", ("event_id",), sample_floor=True)
    done = export_table(events, spec, out, sample_size=300)
    return T.load_delimited(spark, done.path, events.schema, Settings()).good()


@query("select * from orders")
def export_whole(spark, sf):
    """Whole mode with chunking on, thresholds low enough to cut."""
    orders, out = _read(spark, sf, "orders"), scratch_path(spark, "whole")
    settings = Settings(chunking=True, whole_table_mb=0, chunk_mb=0.05)
    done = export_table(orders, ORDERS, out, settings=settings)
    return T.load_delimited(spark, done.path, orders.schema, settings).good()


_MOVED = "(select * from events where ts >= timestamp '2024-01-08' and ts < timestamp '2024-01-22')"


@query(f"""
with c as ({checksum_rows("events", relation=_MOVED)})
select table_name, checksum_class, 'SUCCESS' as status, row_count as source_rows, row_count as target_rows from c
union all select 'events', 'fingerprint', 'SUCCESS', count(*), count(*) from {_MOVED}
""")
def import_job(spark, sf):
    """Export a window, import it twice, and compare the slice on both sides."""
    events, out = _read(spark, sf, "events"), scratch_path(spark, "export")
    target = scratch_path(spark, "imported")
    window = Window("2024-01-08 00:00:00", "2024-01-22 00:00:00")
    done = export_table(events, EVENTS, out, window=window)
    for _ in range(2):
        loaded = import_table(spark, EVENTS, events.schema, out, target, window)
    return R.reconcile(events, loaded, "events", done.condition).select(
        "table_name", "checksum_class", "status", "source_rows", "target_rows"
    )


@query(f"select * from {_MOVED}")
def import_batches(spark, sf):
    """Files loaded three at a time into a target by day; a second run with the same progress adds nothing."""
    events, out = _read(spark, sf, "events"), scratch_path(spark, "export")
    target, progress = scratch_path(spark, "imported"), scratch_path(spark, "progress")
    settings = Settings(files_per_batch=3)
    window = Window("2024-01-08 00:00:00", "2024-01-22 00:00:00")
    export_table(events.repartition(8, "event_id"), EVENTS, out, window=window, settings=settings)
    for _ in range(2):
        loaded = import_table(spark, EVENTS, events.schema, out, target, settings=settings, progress=progress)
    return loaded


@query("""
with d as (select cast(g.d as date) as run_day
           from generate_series(date '2024-01-05', date '2024-01-24', interval 1 day) g(d))
select run_day, 'checked' as status, count(event_id) as row_count, cast(max(event_id) as varchar) as last_id,
       case when run_day < date '2024-01-11' then 'first' else 'second' end as loaded_by
from d left join events on cast(ts as date) = run_day group by run_day
""")
def backfill_resume(spark, sf):
    """A load of some days, then one of more: days that are loaded and checked are not written again."""
    events = _read(spark, sf, "events")
    target, state = scratch_path(spark, "resumed"), scratch_path(spark, "state")
    B.backfill(spark, events, EVENTS, target, "2024-01-05", "2024-01-11", state, "2024-02-01 00:00:00")
    B.backfill(spark, events, EVENTS, target, "2024-01-05", "2024-01-25", state, "2024-02-02 00:00:00")
    name = F.when(F.col("run_ts") < "2024-02-02", "first").otherwise("second")
    return B.day_states(spark, state).select("run_day", "status", "row_count", "last_id", name.alias("loaded_by"))


_BACKFILLED = "(select *, cast(ts as date) as run_day from events where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-25')"


@query(f"""
with c as ({checksum_rows("events", relation=_BACKFILLED, by="run_day")})
select run_day, checksum_class, 'SUCCESS' as status, row_count as source_rows, row_count as target_rows from c
""")
def backfill_job(spark, sf):
    """All days of a range in one load, reported day by day."""
    report = B.backfill(
        spark, _read(spark, sf, "events"), EVENTS, scratch_path(spark, "backfill"),
        "2024-01-05", "2024-01-25",
    )
    return report.select("run_day", "checksum_class", "status", "source_rows", "target_rows")


@query("""
select o_orderkey,
  round(o_totalprice, 1) as rounded,
  round(o_totalprice, -3) as to_thousands,
  cast(round(o_totalprice / 1000) as integer) as thousands,
  coalesce(nullif(o_orderstatus, 'O'), 'open') as status,
  case when o_totalprice < 1000 then 'small' when o_totalprice < 100000 then 'medium' else 'large' end as band,
  o_orderstatus || '/' || o_orderpriority as joined,
  length(o_orderpriority) as priority_length,
  lower(o_orderpriority) as lowered,
  o_orderkey % 7 as remainder,
  o_totalprice / power(1024, 2) as mega,
  round(date_diff('second', timestamp '1995-01-01', o_orderdate) / 604800.0, 4) as weeks,
  try_strptime(cast(o_orderdate as varchar), '%Y-%m-%d %H:%M:%S') is not null as stamp_ok,
  try_strptime(o_orderpriority, '%Y-%m-%d %H:%M:%S') is not null as priority_is_stamp,
  cast(o_orderdate - interval 3 day as date) as three_days_before,
  replace(o_orderpriority, '-', '') as stripped,
  regexp_replace(o_orderpriority, '[0-9]', '#', 'g') as masked,
  split_part('mart.orders.' || o_orderpriority, '.', 3) as last_part,
  sha256(o_orderpriority) as digest
from orders
""")
def scalar_functions(spark, sf):
    price, priority = F.col("o_totalprice"), F.col("o_orderpriority")
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return _read(spark, sf, "orders").select(
        "o_orderkey",
        F.round(price, 1).alias("rounded"),
        F.round(price, -3).alias("to_thousands"),
        F.round(price / 1000).cast("int").alias("thousands"),
        F.coalesce(F.nullif("o_orderstatus", F.lit("O")), F.lit("open")).alias("status"),
        F.when(price < 1000, "small").when(price < 100000, "medium").otherwise("large").alias("band"),
        F.concat("o_orderstatus", F.lit("/"), priority).alias("joined"),
        F.length(priority).cast("bigint").alias("priority_length"),
        F.lower(priority).alias("lowered"),
        (F.col("o_orderkey") % 7).alias("remainder"),
        (price / F.pow(F.lit(1024.0), F.lit(2.0))).alias("mega"),
        F.round(S.weeks_between(F.lit("1995-01-01"), F.col("o_orderdate")), 4).alias("weeks"),
        S.is_timestamp_text(stamp).alias("stamp_ok"),
        S.is_timestamp_text(priority).alias("priority_is_stamp"),
        F.date_sub(F.col("o_orderdate").cast("date"), 3).alias("three_days_before"),
        F.translate(priority, "-", "").alias("stripped"),
        F.regexp_replace(priority, "[0-9]", "#").alias("masked"),
        F.element_at(F.split(F.concat(F.lit("mart.orders."), priority), r"\."), 3).alias("last_part"),
        F.sha2(priority, 256).alias("digest"),
    )
