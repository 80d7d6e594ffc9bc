"""SQL building blocks for oracles: checksums, sizes and chunk cuts written out."""

from __future__ import annotations

# Columns of the test tables per checksum class (fixed values).
CLASSES: dict[str, dict[str, list[str]]] = {
    "lineitem": {
        "string": ["l_returnflag", "l_linestatus"],
        "number": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"],
        "float": ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
        "temporal": ["l_shipdate"],
    },
    "orders": {
        "string": ["o_orderstatus", "o_orderpriority"],
        "number": ["o_orderkey", "o_custkey"],
        "float": ["o_totalprice"],
        "temporal": ["o_orderdate"],
    },
    "events": {
        "string": ["event_type", "props"],
        "number": ["event_id", "user_id"],
        "float": ["value"],
        "temporal": ["ts"],
    },
    "part": {
        "string": ["p_name", "p_brand", "p_type"],
        "number": ["p_partkey", "p_size"],
        "float": ["p_retailprice"],
        "temporal": [],
    },
    "documents": {
        "string": ["text", "lang", "source"],
        "number": ["doc_id", "n_chars"],
        "float": [],
        "temporal": [],
    },
    "embeddings": {
        "string": [],
        "number": ["vec_id", "label"],
        "float": [],
        "temporal": [],
    },
}

KINDS = ("string", "number", "float", "temporal")


def checksum_value(table: str, kind: str) -> str:
    """The checksum of one class as an aggregate expression."""
    columns = CLASSES[table][kind]
    if not columns:
        return "cast(null as double)"
    if kind == "temporal":
        return "cast(" + " + ".join(f"count(distinct {c})" for c in columns) + " as double)"
    inner = {
        "string": "cast(sum(length(coalesce({c}, ''))) as double)",
        "number": "cast(sum(cast(coalesce({c}, 0) as hugeint)) as double)",
        "float": "sum(coalesce({c}, 0.0))",
    }[kind]
    means = [f"round({inner.format(c=c)} / nullif(count(*), 0), 2)" for c in columns]
    return "round(" + " + ".join(means) + ", 2)"


def checksum_rows(table: str, kinds=KINDS, relation: str | None = None, by: str = "") -> str:
    """Checksum lines of one table (or of a relation with its columns)."""
    source = relation or table
    group = f" group by {by}" if by else ""
    lead = f"{by}, " if by else ""
    lines = [
        f"select {lead}'{table}' as table_name, '{kind}' as checksum_class, "
        f"cast({len(CLASSES[table][kind])} as bigint) as column_count, "
        f"{checksum_value(table, kind)} as value, count(*) as row_count from {source}{group}"
        for kind in kinds
    ]
    return "\nunion all\n".join(lines)


def row_bytes(text: list[str], other: list[str]) -> str:
    """Bytes of a row: UTF-8 length of text, 8 for another value, 0 for NULL."""
    parts = [f"coalesce(strlen({c}), 0)" for c in text]
    parts += [f"case when {c} is null then 0 else 8 end" for c in other]
    return "(" + " + ".join(parts) + ")"


def table_bytes(table: str) -> str:
    c = CLASSES[table]
    return row_bytes(c["string"], c["number"] + c["float"] + c["temporal"])


def chunk_cuts(relation: str, key: str, rows: int) -> str:
    """CTEs ``nums``, ``cuts`` and ``ranges`` for the boundaries of a table."""
    return f"""nums as (
  select {key}, row_number() over (order by {key}) as row_num from {relation} where {key} is not null),
cuts as (select row_num, {key} from nums where row_num % {rows} = 0),
ranges as (
  select cast(row_num // {rows} - 1 as integer) as chunk_id, row_num,
         lag({key}) over (order by row_num) as low_key,
         case when lead({key}) over (order by row_num) is null then null else {key} end as high_key
  from cuts
  union all
  select 0, count(*), null, null from nums having count(*) < {rows})"""


def digest_sum(columns: list[str]) -> str:
    """Sum of 60-bit md5 digests over length-prefixed cells."""
    cells = [
        f"coalesce(cast(length(cast({c} as varchar)) as varchar) || ':' || cast({c} as varchar), '-')"
        for c in columns
    ]
    text = " || ".join(cells)
    return f"sum(cast(('0x' || substr(md5({text}), 1, 15)) as bigint))"
