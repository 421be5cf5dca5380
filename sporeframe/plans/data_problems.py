"""Queries of the general data-preparation operators (problems 4 and 7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.missing import sql_absent
from ..operators import impute
from ..operators.unpack import unpack
from ..session import table


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    seq, art = table(spark, sf, "seq_record"), table(spark, sf, "article")
    return (
        unpack(seq, "seq_record.title", "seq_no", "title")
        .unionByName(unpack(seq, "seq_record.note", "seq_no", "note"))
        .unionByName(unpack(art, "article.gb_accessions", "doi", "gb_accessions", "codes"))
    )


def p4_field_counts(spark: SparkSession, sf: str) -> DataFrame:
    """For each field: fields with several values, values, and the most values in one field."""
    per = p4_found(spark, sf).groupBy("field_name", "row_key").agg(F.count("*").alias("n"))
    return per.groupBy("field_name").agg(F.count("*").alias("fields"), F.sum("n").alias("items"), F.max("n").alias("most"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    got = impute.fill(table(spark, sf, "seq_record"), "seq_no", ["geo_loc_name", "specimen_voucher"], ["isolate"], "isolate")
    return got.select("seq_no", "field_name", "item")


def p7_filled(spark: SparkSession, sf: str) -> DataFrame:
    """As p7_found, with how each value was filled."""
    return impute.fill(table(spark, sf, "seq_record"), "seq_no", ["geo_loc_name", "specimen_voucher"], ["isolate"], "isolate")


def p7_dependencies(spark: SparkSession, sf: str) -> DataFrame:
    return impute.dependencies(table(spark, sf, "seq_record"), "seq_no", ["isolate", "strain", "culture_collection"], ["geo_loc_name", "specimen_voucher", "species"])


_CANDIDATES = ("strain", "culture_collection", "isolate")


def p7_mined(spark: SparkSession, sf: str) -> DataFrame:
    """Filled by the determinants that mining proves, then from the records of the same species."""
    return impute.fill_mined(table(spark, sf, "seq_record"), "seq_no", ["geo_loc_name", "specimen_voucher"], _CANDIDATES, "species")


def p7_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Lengths that are missing, from the record of the same isolate that was loaded last before, else first after."""
    return impute.fill_nearest(table(spark, sf, "seq_record"), "seq_no", "bp", "isolate", "loaded_at")


QUERIES = {"p4_found": p4_found, "p4_field_counts": p4_field_counts, "p7_found": p7_found, "p7_filled": p7_filled, "p7_dependencies": p7_dependencies, "p7_mined": p7_mined, "p7_numbers": p7_numbers}


def _p7(columns: str) -> str:
    parts = []
    for t in ("geo_loc_name", "specimen_voucher"):
        parts.append(f"""
        select n.seq_no, '{t}' as field_name, b.v as item, case when b.vals = 1 then 'dependency:isolate' else 'group:isolate' end as filled_by,
               b.n as support, b.complete
        from (select distinct seq_no, isolate from seq_record where {sql_absent(t)} and not {sql_absent('isolate')}) n
        join (select isolate, v, n, sum(n) over (partition by isolate) as complete, count(*) over (partition by isolate) as vals,
                     row_number() over (partition by isolate order by n desc, f) as r
              from (select isolate, {t} as v, count(distinct seq_no) as n, min(seq_no) as f from seq_record
                    where not {sql_absent(t)} and not {sql_absent('isolate')} group by all)) b
          on b.isolate = n.isolate and b.r = 1""")
    return f"select {columns} from ({' union all '.join(parts)})"


def _dep(d: str, t: str) -> str:
    return f"""select '{d}' as determinant, '{t}' as target, count(*) as determinant_values, coalesce(sum(c), 0)::bigint as complete_keys,
      coalesce(sum(m), 0)::bigint as supporting_keys, count(*) filter (where k = 1) as verified_values
    from (select d, sum(n) as c, max(n) as m, count(*) as k from (
      select {d} as d, {t} as v, count(distinct seq_no) as n from seq_record where not {sql_absent(d)} and not {sql_absent(t)} group by all) group by d)"""


def _dictionary(d: str, t: str) -> str:
    return f"""(select d, v, n, complete, vals from (select d, v, n, sum(n) over (partition by d) as complete, count(*) over (partition by d) as vals, row_number() over (partition by d order by n desc, f) as place
      from (select {d} as d, {t} as v, count(distinct seq_no) as n, min(seq_no) as f from seq_record where not {sql_absent(d)} and not {sql_absent(t)} group by all) as c) as p where p.place = 1)"""


def _mined(t: str) -> str:
    picks, joins = [], []
    for i, d in enumerate(_CANDIDATES):
        proven = f"(select count(*) filter (where y.vals = 1) >= 0.5 * count(*) and count(*) > 0 from {_dictionary(d, t)} as y)"
        joins.append(f"left join {_dictionary(d, t)} x{i} on x{i}.d = n.{d} and x{i}.vals = 1 and x{i}.complete >= 2 and {proven}")
        picks.append((f"x{i}", f"dependency:{d}"))
    joins.append(f"left join {_dictionary('species', t)} g on g.d = n.species")
    picks.append(("g", "group:species"))
    pick = lambda c: "case " + " ".join(f"when {x}.v is not null then {x}.{c}" for x, _ in picks) + " end"
    how = "case " + " ".join(f"when {x}.v is not null then '{h}'" for x, h in picks) + " end"
    rows = f"(select distinct seq_no, strain, culture_collection, isolate, species from seq_record where {sql_absent(t)})"
    return f"select n.seq_no, '{t}' as field_name, {pick('v')} as item, {how} as filled_by, {pick('n')}::bigint as support, {pick('complete')}::bigint as complete from {rows} n {' '.join(joins)} where {pick('v')} is not null"


SQL = {
    "p7_found": _p7("seq_no, field_name, item"),
    "p7_filled": _p7("seq_no, field_name, item, filled_by, support::bigint as support, complete::bigint as complete"),
    "p7_dependencies": " union all ".join(_dep(d, t) for d in ("isolate", "strain", "culture_collection") for t in ("geo_loc_name", "specimen_voucher", "species") if d != t),
    "p7_mined": " union all ".join(map(_mined, ("geo_loc_name", "specimen_voucher"))),
    "p7_numbers": f"""select seq_no, 'bp' as field_name, coalesce(b, a) as item, case when b is not null then 'before:isolate' else 'after:isolate' end as filled_by from (select *, last_value(bp ignore nulls) over (partition by isolate order by loaded_at, seq_no rows between unbounded preceding and current row) as b,
      first_value(bp ignore nulls) over (partition by isolate order by loaded_at, seq_no rows between current row and unbounded following) as a from (select distinct seq_no, isolate, bp, loaded_at from seq_record where not {sql_absent('isolate')} and loaded_at is not null)) where bp is null and coalesce(b, a) is not null""",
}
