"""Queries of the llm operators and their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.missing import absent, sql_absent
from ..session import table
from . import bpe, canonical, components, linkage, packing, scanfix, survivor, toxicity


def _trust():
    """Extraction confidence as a number."""
    return F.expr("case lower(trim(confidence)) when 'high' then 3 when 'medium' then 2 when 'low' then 1 else 0 end")



def _place_values(spark: SparkSession, sf: str) -> DataFrame:
    parts = [("seq_record", "seq_no", "geo_loc_name"), ("gb_table_row", "row_id", "country"), ("type_registry", "record_id", "locality_raw")]
    out = None
    for t, key, field in parts:
        x = table(spark, sf, t)
        x = x.filter(~absent(x[field])).select(F.lit(f"{t}.{field}").alias("field_name"), F.col(key).cast("string").alias("row_key"), F.col(field).alias("value")).distinct()
        out = x if out is None else out.unionByName(x)
    return out


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    rows = _place_values(spark, sf)
    ref = canonical.country_reference(spark, table(spark, sf, "country_variant"), table(spark, sf, "locality_cache"))
    return rows.join(canonical.map_countries(rows, "value", ref), "value").select("field_name", "row_key", "country")


def p1_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    """Unmatched values with their number of rows by field."""
    rows = _place_values(spark, sf)
    ref = canonical.country_reference(spark, table(spark, sf, "country_variant"), table(spark, sf, "locality_cache"))
    none = canonical.map_countries(rows, "value", ref).filter(F.col("country") == canonical.UNMATCHED).select("value")
    return rows.join(none, "value").groupBy("field_name", "value").agg(F.count("*").alias("n"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "gb_table_row").withColumn("_acc", survivor.accession_key("gb_its"))
    fields = {"species": survivor.species_incomplete, "voucher": survivor.code_incomplete, "country": survivor.never}
    return survivor.survivors(rows, ["source_doi", "_acc"], "row_id", fields, _trust(), "extracted_at")


def p2_undated(spark: SparkSession, sf: str) -> DataFrame:
    """As p2_found with the time of every third row taken away: learned precedences order what has none."""
    rows = table(spark, sf, "gb_table_row").withColumn("_acc", survivor.accession_key("gb_its")).withColumn("extracted_at", F.when(F.col("row_id") % 3 != 0, F.col("extracted_at")))
    fields = {"species": survivor.species_incomplete, "voucher": survivor.code_incomplete, "country": survivor.never}
    return survivor.survivors(rows, ["source_doi", "_acc"], "row_id", fields, _trust(), "extracted_at")


def p2_precedences(spark: SparkSession, sf: str) -> DataFrame:
    """Learned value transitions of the three fields."""
    rows = table(spark, sf, "gb_table_row").withColumn("_acc", survivor.accession_key("gb_its")).dropna(subset=["source_doi", "_acc"])
    keys = ["source_doi", "_acc"]
    return survivor.precedences(survivor.long_form(rows, keys, "row_id", ["species", "voucher", "country"], _trust(), "extracted_at"), keys)


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return p3_links(spark, sf).select("doc_row_id", "supp_row_id")


def p3_links(spark: SparkSession, sf: str) -> DataFrame:
    """The matches with their confidence."""
    docs, supps = table(spark, sf, "doc_row"), table(spark, sf, "supp_record")
    ref = canonical.country_reference(spark, table(spark, sf, "country_variant"), table(spark, sf, "locality_cache"))
    names = canonical.map_countries(docs.select("country").union(supps.select("country")), "country", ref)
    return linkage.link(docs, supps, names)


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    pairs, ids = table(spark, sf, "code_match"), table(spark, sf, "seq_record").select("seq_no").distinct()
    got = components.groups(pairs, "seq_no_a", "seq_no_b", ids)
    return got.select(F.col("id").alias("seq_no"), "group_id")


def p5_group_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """How many groups there are of each size."""
    sizes = p5_found(spark, sf).groupBy("group_id").agg(F.count("*").alias("size"))
    return sizes.groupBy("size").agg(F.count("*").alias("groups"))


def _scans(spark: SparkSession, sf: str) -> scanfix.Repair:
    return scanfix.Repair(scanfix.scanned_rows(table(spark, sf, "section_block"), table(spark, sf, "doc_row")))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return _scans(spark, sf).found()


def p6_text(spark: SparkSession, sf: str) -> DataFrame:
    """The repaired paragraphs."""
    return _scans(spark, sf).text()


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.encode(table(spark, sf, "documents"), "doc_id", "text")


def p8_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.token_counts(table(spark, sf, "documents"), "doc_id", "text")


def p9_packed(spark: SparkSession, sf: str) -> DataFrame:
    sizes = bpe.token_counts(table(spark, sf, "documents"), "doc_id", "text")
    return packing.pack(sizes, "doc_id", "n", table(spark, sf, "container_size"))


def p9_waste(spark: SparkSession, sf: str) -> DataFrame:
    """For each capacity: items, pieces, containers, the least number possible, and the share of room left unused."""
    got = p9_packed(spark, sf).filter("n > 0").groupBy("size_name", "container_id").agg(F.sum("n").alias("used"), F.count("*").alias("pieces"))
    per = got.groupBy("size_name").agg(F.count("*").alias("containers"), F.sum("pieces").alias("pieces"), F.sum("used").alias("tokens"), F.max("used").alias("fullest"))
    caps = table(spark, sf, "container_size").select("size_name", F.col("capacity_tokens").cast("long").alias("cap")).distinct()
    return per.join(caps, "size_name").select("size_name", "pieces", "containers", F.ceil(F.col("tokens") / F.col("cap")).alias("least"), "tokens", "fullest", F.round(1 - F.col("tokens") / (F.col("containers") * F.col("cap")), 5).alias("unused"))


def p10_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's score in each category."""
    docs = table(spark, sf, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf, "labels")))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return p10_scores(spark, sf).filter("found").select("doc_id", "category").distinct()


def p10_source_rates(spark: SparkSession, sf: str) -> DataFrame:
    """For each source and category: documents, those in the category, and their share."""
    got = p10_scores(spark, sf).join(table(spark, sf, "documents").select("doc_id", "source").distinct(), "doc_id")
    rates = got.groupBy("source", "category").agg(F.count("*").alias("documents"), F.count_if("found").alias("found"))
    return rates.withColumn("rate", F.round(F.col("found") / F.col("documents"), 6))


QUERIES = {"p1_found": p1_found, "p1_unmatched": p1_unmatched, "p2_found": p2_found, "p2_undated": p2_undated, "p2_precedences": p2_precedences, "p3_found": p3_found, "p3_links": p3_links, "p5_found": p5_found, "p5_group_sizes": p5_group_sizes, "p6_found": p6_found, "p6_text": p6_text, "p8_ids": p8_ids, "p8_token_counts": p8_token_counts, "p9_packed": p9_packed, "p9_waste": p9_waste, "p10_found": p10_found, "p10_scores": p10_scores, "p10_source_rates": p10_source_rates}


def _p2_sql() -> str:
    fields = []
    for f in ("species", "voucher", "country"):
        if f == "species":
            words = "string_split(regexp_replace(regexp_replace(v, '\\s+', ' ', 'g'), ' (cf|aff|nr|subsp|ssp|var|f)\\.? ', ' ', 'g'), ' ')"
            bad = f"(regexp_matches(v, '^\\pL{{1,4}}\\.') or len({words}) < 2 or regexp_replace({words}[2], '\\.$', '') in ('sp', 'spp', 'species', 'cf', 'aff', 'nr', 'gen', 'indet', 'nov'))"
        elif f == "voucher":
            bad = "not (regexp_matches(v, '\\pL') and regexp_matches(v, '\\pN'))"
        else:
            bad = "false"
        fields.append(f"""{f}_v as (select source_doi, acc, v, max((c, extracted_at, -row_id)) as b, {bad} as bad from (select *, regexp_replace({f}, '^\\s+|\\s+$', '', 'g') as v from r where not {sql_absent(f)}) group by source_doi, acc, v),
      {f}_b as (select source_doi, acc, arg_max(v, (ok, b)) as {f} from (select x.*, not x.bad and not exists (from {f}_v y where y.source_doi = x.source_doi and y.acc = x.acc and length(y.v) > length(x.v) and starts_with(lower(y.v), lower(x.v))) as ok from {f}_v x) group by 1, 2)""")
    return f"""with r as (select distinct row_id, source_doi, upper(regexp_replace(regexp_replace(gb_its, '\\s+', '', 'g'), '\\.\\d+$', '')) as acc, species, voucher, country, extracted_at,
        case lower(trim(confidence)) when 'high' then 3 when 'medium' then 2 when 'low' then 1 else 0 end as c from gb_table_row where not {sql_absent('gb_its')} and source_doi is not null),
      g as (select source_doi, acc, min(row_id) as group_id from r group by 1, 2 having count(distinct row_id) > 1), {', '.join(fields)}
      select group_id, coalesce(species, '') as species, coalesce(voucher, '') as voucher, coalesce(country, '') as country from g
      left join species_b using (source_doi, acc) left join voucher_b using (source_doi, acc) left join country_b using (source_doi, acc)"""


def _p2_undated_sql() -> str:
    """The same by a recursive closure of the learned order inside each group; absent times compare as the earliest."""
    words = "string_split(regexp_replace(regexp_replace(value, '\\s+', ' ', 'g'), ' (cf|aff|nr|subsp|ssp|var|f)\\.? ', ' ', 'g'), ' ')"
    bad = f"""case field when 'species' then (regexp_matches(value, '^\\pL{{1,4}}\\.') or len({words}) < 2 or regexp_replace({words}[2], '\\.$', '') in ('sp', 'spp', 'species', 'cf', 'aff', 'nr', 'gen', 'indet', 'nov'))
      when 'voucher' then not (regexp_matches(value, '\\pL') and regexp_matches(value, '\\pN')) else false end"""
    long = " union ".join(f"select g, id, trust, ts, '{f}' as field, regexp_replace({f}, '^\\s+|\\s+$', '', 'g') as value from r where not {sql_absent(f)}" for f in ("species", "voucher", "country"))
    none = "timestamp '0001-01-01'"
    return f"""with recursive r as materialized (select distinct row_id as id, source_doi || '#' || upper(regexp_replace(regexp_replace(gb_its, '\\s+', '', 'g'), '\\.\\d+$', '')) as g, species, voucher, country, case when row_id % 3 <> 0 then extracted_at end as ts,
        case lower(trim(confidence)) when 'high' then 3 when 'medium' then 2 when 'low' then 1 else 0 end as trust from gb_table_row where not {sql_absent('gb_its')} and source_doi is not null),
      l as materialized ({long}),
      step as (select field, value as a, lead(value) over (partition by g, field order by ts, id) as b from l where ts is not null),
      net as (select field, least(a, b) as x, greatest(a, b) as y, sum(case when a < b then 1 else -1 end) as s from step where a <> b group by all having s <> 0),
      known as materialized (select field, case when s > 0 then x else y end as a, case when s > 0 then y else x end as b from net),
      v as materialized (select g, field, value, max((trust, coalesce(ts, {none}), -id)) as k from l group by all),
      w as materialized (select g, field, value, k[1] as trust, nullif(k[2], {none}) as ts, k[3] as k from v),
      direct as materialized (select p.g, p.field, p.value as a, q.value as b, p.ts as ta, q.ts as tb from w p join known n on n.field = p.field and n.a = p.value join w q on q.g = p.g and q.field = p.field and q.value = n.b where p.ts is null or q.ts is null),
      reach as (select * from direct union select x.g, x.field, x.a, d.b, x.ta, d.tb from reach x join direct d on d.g = x.g and d.field = x.field and d.a = x.b and x.tb is null where x.ta is null or d.tb is null),
      order_ as materialized (select x.* from reach x anti join reach y on y.g = x.g and y.field = x.field and y.a = x.b and y.b = x.a),
      until as (select g, field, a as value, min(tb) as u from order_ where ta is null group by all), since as (select g, field, b as value, max(ta) as s, count_if(ta is null) as depth from order_ where tb is null group by all),
      place as materialized (select g, field, value, coalesce(u - interval 1 microsecond, s + interval 1 microsecond) as near, depth from until full join since using (g, field, value)),
      low as (select o.g, o.field, o.b as value, max(near) as near from order_ o join place p on p.g = o.g and p.field = o.field and p.value = o.a where ta is null and tb is null group by all),
      judged as (select w.g, w.field, w.value, (not {bad.replace('value', 'w.value').replace('field', 'w.field')} and not exists (from w z where z.g = w.g and z.field = w.field and length(z.value) > length(w.value) and starts_with(lower(z.value), lower(w.value))),
        w.trust, coalesce(w.ts, greatest(p.near, o.near), {none}), coalesce(p.depth, 0), w.k, w.value) as rank from w left join place p using (g, field, value) left join low o using (g, field, value)),
      best as (select g, field, arg_max(value, rank) as value from judged group by all)
      select min(id) as group_id, coalesce((select value from best b where b.g = r.g and field = 'species'), '') as species, coalesce((select value from best b where b.g = r.g and field = 'voucher'), '') as voucher, coalesce((select value from best b where b.g = r.g and field = 'country'), '') as country
      from r group by g having count(distinct id) > 1"""


_P5 = """with recursive ids as materialized (select distinct seq_no from seq_record), p as materialized (select distinct seq_no_a as a, seq_no_b as b from code_match where seq_no_a <> seq_no_b and seq_no_a in (from ids) and seq_no_b in (from ids)),
  e as materialized (select a, b from p union select b, a from p), r as (select a as x, a as l from e union select e.b, r.l from r join e on e.a = r.x where r.l < e.b), c as (select x as seq_no, min(l) as group_id from r group by 1)"""

SQL: dict[str, str] = {
    "p2_found": _p2_sql(),
    "p2_undated": _p2_undated_sql(),
    "p5_found": f"{_P5} select seq_no, group_id from c",
    "p5_group_sizes": f"{_P5} select size, count(*) as groups from (select group_id, count(*) as size from c group by 1) group by 1",
}
