"""Queries on sequence records: codes, gaps, markers, clusters and the specimen matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions.missing import absent, missing, sql_absent
from ..operators import cluster, frames, matrix
from ..session import table

MARKERS = matrix.MARKERS
_MISS = lambda c, *t: f"(coalesce(lower(trim({c})), '') in ({', '.join(repr(x) for x in ('', 'nan', *t))}))"
_INCOMPLETE = lambda c: f"(coalesce(trim({c}) = '' or regexp_matches(trim({c}), '(?i)^\\S+\\s+sp\\.?(\\s|$)') or regexp_matches(trim({c}), '(?i)^\\S*(aceae|ales|mycetes|mycota)$') or not regexp_matches(trim({c}), '\\s'), true))"


def seq(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Sequence records, each once, with the given columns."""
    return table(spark, sf, "seq_record").select("seq_no", *columns).distinct()


def _norm(f):
    def q(spark: SparkSession, sf: str) -> DataFrame:
        return seq(spark, sf, "specimen_voucher").filter("specimen_voucher is not null").select("seq_no", f(F.col("specimen_voucher")).alias("code"))

    return q


def _norm_sql(expr: str) -> str:
    return f"select distinct seq_no, {expr} as code from seq_record where specimen_voucher is not null"


def clean_text(spark, sf):
    return seq(spark, sf, "title", "note").select("seq_no", C.clean_text(F.col("title")).alias("title"), C.clean_text(F.col("note")).alias("note"))


def dedup_rows(spark, sf):
    """Records fetched more than once: one row for all that agree in everything but number and times."""
    t = table(spark, sf, "seq_record")
    same = [c for c in t.columns if c not in ("seq_no", "deposited_at", "loaded_at")]
    return t.groupBy(*same).agg(F.min("seq_no").alias("seq_no")).select("seq_no", "gbn", "species")


def gap_flags(spark, sf):
    t = frames.gap_flags(seq(spark, sf, "specimen_voucher", "geo_loc_name", "species"), "specimen_voucher", "geo_loc_name", "species")
    return t.select("seq_no", "voucher_gap", "country_gap", "species_gap", "embedded_code")


_FLAGS = f"""select distinct seq_no, {_MISS('specimen_voucher', 'none')} as voucher_gap, {_MISS('geo_loc_name')} as country_gap, {_INCOMPLETE('species')} as species_gap,
  coalesce(regexp_matches(species, '^([A-Za-z0-9_]+)\\s+sp\\.?\\s+(.*)$') and trim(regexp_extract(species, '^([A-Za-z0-9_]+)\\s+sp\\.?\\s+(.*)$', 2)) <> '', false) as embedded_code from seq_record"""


def gap_summary(spark, sf):
    f = gap_flags(spark, sf)
    return f.agg(F.count("*").alias("records"), *[F.count_if(c).alias(c) for c in ("voucher_gap", "country_gap", "species_gap", "embedded_code")])


def gap_rows(spark, sf):
    return gap_flags(spark, sf).filter("voucher_gap or country_gap or species_gap").select("seq_no")


def split_embedded_code(spark, sf):
    t = seq(spark, sf, "species", "specimen_voucher").withColumn("e", C.embedded_code(F.concat_ws(" ", "species", F.when(F.col("seq_no") % 3 == 0, F.lit("FL01")))))
    return t.select("seq_no", F.coalesce("e.species", "species").alias("species"), F.when(missing("specimen_voucher"), F.col("e.code")).otherwise(F.col("specimen_voucher")).alias("voucher"))


def note_codes(spark, sf):
    return seq(spark, sf, "note").select("seq_no", F.array_join(C.note_codes(F.col("note")), "|").alias("codes")).filter("codes <> ''")




def code_classes(spark, sf):
    """How many distinct specimen codes look like what."""
    v = F.col("specimen_voucher")
    t = seq(spark, sf, "specimen_voucher").filter("specimen_voucher is not null")
    return t.agg(F.count_if(C.invalid_code(v)).alias("invalid"), F.count_if(C.looks_like_specimen_code(v)).alias("specimen_code"), F.count_if(C.accession_like(v)).alias("accession"), F.count_if(C.citation_marker(v)).alias("citation"), F.count_if(absent(v)).alias("absent"))


def accession_versions(spark, sf):
    """Accessions without version that occur in several records."""
    t = seq(spark, sf, "gbn").filter("gbn is not null").withColumn("accession", F.upper(C.without_version(F.trim("gbn"))))
    return t.groupBy("accession").agg(F.count("*").alias("records"), F.count_distinct("gbn").alias("spellings"), F.min("seq_no").alias("first")).filter("records > 1")


def marker_longest_phrase(spark, sf):
    return seq(spark, sf, "description").select("seq_no", matrix.marker_of(F.col("description")).alias("marker"))


def _marker_sql(c: str = "description") -> str:
    lines = [f"when contains(lower({c}), '{p}') then '{m}'" for m, p in sorted(matrix.PHRASES, key=lambda x: -len(x[1]))]
    lines += [f"when regexp_matches(lower({c}), '{p}')" + (f" and not regexp_matches(lower({c}), '{no}')" if no else "") + f" then '{m}'" for m, p, no in matrix.FALLBACK]
    return "case " + " ".join(lines) + " end"


def marker_unclassified(spark, sf):
    t = seq(spark, sf, "description").filter(matrix.marker_of(F.col("description")).isNull())
    return t.groupBy("description").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "description")


def _keyed(spark, sf, *columns):
    v = F.col("specimen_voucher")
    t = seq(spark, sf, "specimen_voucher", "gbn", *columns)
    return t.withColumn("code", F.when(~absent(v) & ~C.invalid_code(v), C.code_key_dictionary(v))).filter("code <> ''")


def specimen_matrix(spark, sf):
    """Flagship: one row a specimen code with joined sets and the last accession of each marker."""
    t = _keyed(spark, sf, "species", "geo_loc_name", "host", "type_material", "description").withColumn("marker", matrix.marker_of(F.col("description")))
    return matrix.specimen_matrix(t, "code", ["species", "geo_loc_name", "host", "type_material"], "marker", "gbn", "seq_no", MARKERS)


_CODE = "upper(regexp_replace(regexp_replace(specimen_voucher, '\\(.*?\\)', '', 'g'), '[\\s:/-]', '', 'g'))"
_KEYED = f"(select distinct seq_no, {_CODE} as code, gbn, species, geo_loc_name, host, type_material, {_marker_sql()} as marker from seq_record where not {sql_absent('specimen_voucher')} and not regexp_matches(trim(specimen_voucher), '^[0-9]$') and {_CODE} <> '')"
_SET = lambda c: f"coalesce(string_agg(distinct {c}, ' | ' order by {c}) filter (where not {sql_absent(c)}), '') as {c}"
_MATRIX = f"select code, {', '.join(map(_SET, ('species', 'geo_loc_name', 'host', 'type_material')))}, {', '.join(f'''arg_max(gbn, seq_no) filter (where marker = '{m}') as {m}''' for m in MARKERS)} from {_KEYED} group by code"


def specimen_long(spark, sf):
    t = _keyed(spark, sf, "description").withColumn("marker", matrix.marker_of(F.col("description")))
    return matrix.long_matrix(t, "code", "marker", "gbn", "seq_no")


def multiloci_counts(spark, sf):
    return specimen_matrix(spark, sf).groupBy("how_multiloci").agg(F.count("*").alias("specimens"))


def _values(spark, sf):
    t = seq(spark, sf, "specimen_voucher", "culture_collection")
    parts = [t.filter(~absent(c)).select("seq_no", C.code_key_dictionary(F.col(c)).alias("value")) for c in ("specimen_voucher", "culture_collection")]
    return parts[0].union(parts[1]).filter("value <> ''").filter(~C.invalid_code(F.col("value"))).distinct()


_VALUES = " union ".join(f"select seq_no, upper(regexp_replace(regexp_replace({c}, '\\(.*?\\)', '', 'g'), '[\\s:/-]', '', 'g')) as value from seq_record where not {sql_absent(c)}" for c in ("specimen_voucher", "culture_collection"))
_VALUES = f"(select distinct * from ({_VALUES}) where value <> '' and not regexp_matches(value, '^[0-9]$'))"
_CLUSTERS = f"""with recursive v as materialized {_VALUES}, e as materialized (select distinct a.seq_no as x, b.seq_no as y from v a join v b using (value)),
  r as (select x, y from e union select r.x, e.y from r join e on r.y = e.x), c as (select x as seq_no, min(y) as cluster from r group by x)"""


def shared_value_clusters(spark, sf):
    return cluster.components(_values(spark, sf), "seq_no", "value")


def cluster_key(spark, sf):
    v = _values(spark, sf)
    return cluster.representative(v.join(cluster.components(v, "seq_no", "value"), "seq_no"), "cluster", "value")


def alias_map(spark, sf):
    """Cluster keys with the spellings of their codes."""
    v = _values(spark, sf)
    got = v.join(cluster.components(v, "seq_no", "value"), "seq_no")
    return cluster.aliases(got.join(cluster.representative(got, "cluster", "value"), "cluster"), "cluster_key", "value").select("cluster_key", F.array_join("aliases", "|").alias("aliases"))


def code_to_cluster(spark, sf):
    """Codes of table rows mapped to the cluster of the sequence records, or kept."""
    v = _values(spark, sf)
    got = v.join(cluster.components(v, "seq_no", "value"), "seq_no")
    key = got.join(cluster.representative(got, "cluster", "value"), "cluster").groupBy("value").agg(F.min("cluster_key").alias("key"))
    rows = table(spark, sf, "gb_table_row").select("row_id", "voucher").distinct().filter(~absent("voucher")).withColumn("value", C.code_key_dictionary(F.col("voucher")))
    return rows.join(key, "value", "left").select("row_id", F.coalesce("key", "value").alias("specimen"), F.col("key").isNotNull().alias("known"))


_KEYS = f"{_CLUSTERS}, g as (select v.value, c.cluster, v.seq_no from v join c using (seq_no)), k as (select cluster, arg_min(value, (regexp_matches(value, '^[0-9]+$'), length(value), value)) as cluster_key from g group by cluster)"


def genus_counts(spark, sf):
    t = seq(spark, sf, "species").withColumn("genus", C.genus_of(F.col("species")))
    return t.groupBy("genus").agg(F.count("*").alias("records"), F.count_distinct("species").alias("names"))


def latest_stamp(spark, sf):
    """The newest date embedded in file names; months in any case."""
    t = seq(spark, sf, "loaded_at").select(F.concat(F.lit("records_"), F.lower(F.date_format("loaded_at", "ddMMMyyyy")), F.lit(".gb")).alias("f"))
    return t.agg(F.max(F.to_date(F.initcap(F.regexp_extract("f", "_(\\d{2}[a-z]{3}\\d{4})\\.gb", 1)), "ddMMMyyyy")).cast("string").alias("latest"))


def validate_voucher(spark, sf):
    """Table vouchers proposed for records of the same accession: decision and reason."""
    t = seq(spark, sf, "gbn", "specimen_voucher").filter("gbn is not null").withColumn("acc", F.upper(C.without_version(F.trim("gbn"))))
    p = table(spark, sf, "gb_table_row").select("row_id", "voucher", F.upper(C.without_version(F.trim("gb_its"))).alias("acc")).distinct()
    d = frames.judge_voucher(F.col("voucher"), F.col("specimen_voucher"), F.col("gbn"))
    return t.join(p, "acc").withColumn("d", d).groupBy("d.status", "d.reason").agg(F.count("*").alias("n"), F.count_distinct("d.value").alias("values"))


_N3 = lambda c: f"lower(regexp_replace({c}, '[\\s:\\-_,.;()\\[\\]{{}}]', '', 'g'))"
_CASES = f"""case when {_MISS('voucher', 'none')} then 'rejected/empty' when regexp_matches(voucher, '^\\s*[\\[(]?\\d{{1,3}}[\\])]?\\s*$') then 'rejected/citation_marker'
  when {_N3("regexp_replace(voucher, '\\.\\d+$', '')")} = {_N3("regexp_replace(gbn, '\\.\\d+$', '')")} then 'rejected/own_accession'
  when regexp_matches(voucher, '^[A-Z]{{1,3}}\\d{{5,8}}(\\.\\d+)?$') and not regexp_matches(voucher, '^[A-Z]{{2,6}}\\d{{4,}}$') then 'rejected/looks_like_accession'
  when not regexp_matches(voucher, '[0-9]') then 'rejected/no_digit' when not {_MISS('specimen_voucher', 'none')} and {_N3('voucher')} = {_N3('specimen_voucher')} then 'deferred/already_present'
  when not {_MISS('specimen_voucher', 'none')} then 'deferred/voucher_conflict' else 'accepted/ok' end"""


def validate_species(spark, sf):
    t = seq(spark, sf, "gbn", "species").filter("gbn is not null").withColumn("acc", F.upper(C.without_version(F.trim("gbn"))))
    p = table(spark, sf, "gb_table_row").select("row_id", F.col("species").alias("candidate"), F.upper(C.without_version(F.trim("gb_its"))).alias("acc")).distinct()
    known = table(spark, sf, "type_registry").select(F.substring_index("species", " ", 1).alias("genus"), F.lit(True).alias("known")).distinct()
    j = t.join(p, "acc").withColumn("genus", F.substring_index("candidate", " ", 1)).join(known, "genus", "left")
    d = frames.judge_species(F.col("candidate"), F.col("species"), F.coalesce("known", F.lit(False)))
    return j.withColumn("d", d).groupBy("d.status", "d.reason").agg(F.count("*").alias("n"))


def apply_if_missing(spark, sf):
    """Records whose blank voucher takes the first table voucher of their accession."""
    t = seq(spark, sf, "gbn", "specimen_voucher").filter("gbn is not null").withColumn("acc", F.upper(C.without_version(F.trim("gbn")))).filter(missing("specimen_voucher"))
    p = table(spark, sf, "gb_table_row").filter(~absent("voucher")).groupBy(F.upper(C.without_version(F.trim("gb_its"))).alias("acc")).agg(F.min_by("voucher", "row_id").alias("voucher"))
    return t.join(p, "acc").select("seq_no", "voucher")


def audit_append(spark, sf):
    t = seq(spark, sf, "host", "type_material")
    return t.select("seq_no", C.audit_append(F.col("host"), F.concat_ws("; ", "type_material", "host")).alias("audit")).filter("audit <> ''")


def fallback_values(spark, sf):
    """Blank countries filled from the first source that knows the accession: article tables, then document rows."""
    acc = F.upper(C.without_version(F.trim("gbn")))
    t = seq(spark, sf, "gbn", "geo_loc_name").filter(absent("geo_loc_name") & F.col("gbn").isNotNull()).select("seq_no", acc.alias("acc"))
    g = table(spark, sf, "gb_table_row").filter(~absent("country")).groupBy(F.upper(C.without_version(F.trim("gb_its"))).alias("acc")).agg(F.min_by("country", "row_id").alias("c"))
    d = table(spark, sf, "doc_row").filter(~absent("country")).groupBy(F.upper(C.without_version(F.trim("accession"))).alias("acc")).agg(F.min_by("country", "row_id").alias("c"))
    return frames.priority_fallback(t, "acc", [("table", g, "c"), ("document", d, "c")]).select("acc", "value", "method").distinct()


def _perturbed(spark, sf):
    t = specimen_matrix(spark, sf)
    new = t.filter(F.length("code") % 7 != 0).withColumn("host", F.when(F.length("code") % 5 == 0, "revised").otherwise(F.col("host")))
    return (frames.signatures(x, "code", MARKERS).groupBy("signature").agg(F.min_by("species", "code").alias("species"), F.min_by("host", "code").alias("host")) for x in (t, new))


def signature_diff(spark, sf):
    a, b = _perturbed(spark, sf)
    return frames.review(a, b, ["species", "host"])


def diff_summary(spark, sf):
    return signature_diff(spark, sf).groupBy("change").agg(F.count("*").alias("cells"), F.count_distinct("signature").alias("signatures"))


_SIG = "array_to_string(list_filter([" + ", ".join(f"case when not {_MISS(m, 'none')} then '{m}=' || trim({m}) end" for m in MARKERS) + "], lambda x: x is not null), ';')"
_DIFF = f"""with m as materialized (select * from ({_MATRIX})), a as (select signature, arg_min(species, code) as species, arg_min(host, code) as host from (select *, {_SIG} as signature from m) where signature <> '' group by 1),
  b as (select signature, arg_min(species, code) as species, arg_min(h, code) as host from (select *, {_SIG} as signature, case when length(code) % 5 = 0 then 'revised' else host end as h from m where length(code) % 7 <> 0) where signature <> '' group by 1),
  j as (select coalesce(a.signature, b.signature) as signature, a.signature as sa, b.signature as sb, a.species as s1, b.species as s2, a.host as h1, b.host as h2 from a full join b on a.signature = b.signature),
  d as (select signature, 'removed' as change, '' as "column", null::varchar as "before", null::varchar as "after" from j where sb is null union all
        select signature, 'added', '', null, null from j where sa is null union all
        select signature, 'changed', 'species', s1, s2 from j where sa is not null and sb is not null and s1 is distinct from s2 union all
        select signature, 'changed', 'host', h1, h2 from j where sa is not null and sb is not null and h1 is distinct from h2)"""


def type_label(spark, sf):
    t = seq(spark, sf, "type_material").filter(~absent("type_material"))
    x = F.lower("type_material")
    label = F.when(x.rlike(r"\bculture of"), "ex-type")
    for k in ("holotype", "isotype", "paratype", "neotype", "lectotype", "epitype", "syntype", "type"):
        label = label.when(x.rlike(rf"\b{k}\b"), k)
    return t.withColumn("label", label).groupBy("label").agg(F.count("*").alias("records"))


QUERIES = {
    "norm_codes_n1": _norm(C.code_key_dictionary), "norm_codes_n2": _norm(C.code_key_cleanup), "norm_codes_n3": _norm(C.code_key_match), "norm_codes_n4": _norm(C.code_key_prose), "norm_codes_n5": _norm(C.code_key_type),
    **{f.__name__: f for f in (clean_text, dedup_rows, gap_flags, gap_summary, gap_rows, split_embedded_code, note_codes, code_classes, accession_versions, marker_longest_phrase, marker_unclassified, specimen_matrix, specimen_long, multiloci_counts, shared_value_clusters, cluster_key, alias_map, code_to_cluster, genus_counts, latest_stamp, validate_voucher, validate_species, apply_if_missing, audit_append, fallback_values, signature_diff, diff_summary, type_label)},
}

_ACC = lambda c: f"upper(regexp_replace(trim({c}), '\\.\\d+$', ''))"
_SEQ = "(select distinct seq_no, gbn, specimen_voucher, species, geo_loc_name, host, type_material, note, title, description, loaded_at from seq_record)"
_CLEAN = lambda c: f"regexp_replace(coalesce({c}, ''), '[\\[\\]''\\\\]', '', 'g') as {c}"
_P = lambda k: f"regexp_extract_all(note, '{k} ([A-Za-z0-9 .:-]+)', 1)"
SQL = {
    "norm_codes_n1": _norm_sql(_CODE),
    "norm_codes_n2": _norm_sql("regexp_replace(lower(specimen_voucher), '[\\s:\\-_]', '', 'g')"),
    "norm_codes_n3": _norm_sql(_N3("specimen_voucher")),
    "norm_codes_n4": _norm_sql("upper(regexp_replace(specimen_voucher, '[\\s:/\\-.,;()\\[\\]{}]', '', 'g'))"),
    "norm_codes_n5": _norm_sql("upper(regexp_replace(specimen_voucher, '[ \\-/.:]', '', 'g'))"),
    "clean_text": f"select distinct seq_no, {_CLEAN('title')}, {_CLEAN('note')} from seq_record",
    "dedup_rows": "select min(seq_no) as seq_no, gbn, species from seq_record group by species, gbn, description, bp, title, seq_text, strain, specimen_voucher, isolate, environmental_sample, culture_collection, bio_material, geo_loc_name, host, type_material, note",
    "gap_flags": _FLAGS,
    "gap_summary": f"select count(*) as records, {', '.join(f'count_if({c}) as {c}' for c in ('voucher_gap', 'country_gap', 'species_gap', 'embedded_code'))} from ({_FLAGS})",
    "gap_rows": f"select seq_no from ({_FLAGS}) where voucher_gap or country_gap or species_gap",
    "split_embedded_code": f"""select seq_no, case when ok then regexp_extract(s, '^([A-Za-z0-9_]+)', 1) || ' sp.' else species end as species,
      case when {_MISS('specimen_voucher', 'none')} then case when ok then code end else specimen_voucher end as voucher
      from (select *, coalesce(code <> '', false) as ok from (select *, trim(regexp_extract(s, '^([A-Za-z0-9_]+)\\s+sp\\.?\\s+(.*)$', 2)) as code from (
        select distinct seq_no, species, specimen_voucher, concat_ws(' ', species, case when seq_no % 3 = 0 then 'FL01' end) as s from seq_record)))""",
    "note_codes": f"""select seq_no, string_agg(c, '|' order by o) as codes from (select seq_no, c, min(o) as o from (
      select seq_no, trim(regexp_replace(trim(unnest(l)), '[;,.]+$', '')) as c, generate_subscripts(l, 1) as o from (
        select seq_no, list_concat(list_concat({_P('(?:strain )?also named')}, {_P('found in strain')}), {_P('also known as')}) as l from {_SEQ} where note is not null))
      where c <> '' and not regexp_matches(c, '^[A-Z][a-z]+ [a-z]+$') group by 1, 2) group by 1""",
    "code_classes": f"""select count_if(v = '' or regexp_matches(trim(v), '^[0-9]$')) as invalid, count_if(regexp_matches(v, '^[A-Z]{{2,6}}\\d{{4,}}$')) as specimen_code, count_if(regexp_matches(v, '^[A-Z]{{1,3}}\\d{{5,8}}(\\.\\d+)?$')) as accession,
      count_if(regexp_matches(v, '^\\s*[\\[(]?\\d{{1,3}}[\\])]?\\s*$')) as citation, count_if({sql_absent('v')}) as absent from (select distinct seq_no, specimen_voucher as v from seq_record where specimen_voucher is not null)""",
    "accession_versions": f"select {_ACC('gbn')} as accession, count(*) as records, count(distinct gbn) as spellings, min(seq_no) as first from (select distinct seq_no, gbn from seq_record where gbn is not null) group by 1 having count(*) > 1",
    "marker_longest_phrase": f"select distinct seq_no, {_marker_sql()} as marker from seq_record",
    "marker_unclassified": f"select description, count(*) as n from (select distinct seq_no, description from seq_record) where {_marker_sql()} is null group by 1",
    "specimen_matrix": f"select *, {' + '.join(f'''(case when coalesce({m}, '') <> '' then 1 else 0 end)''' for m in MARKERS)} as how_multiloci from ({_MATRIX})",
    "specimen_long": f"select code, marker, arg_max(gbn, seq_no) as gbn from {_KEYED} where marker is not null group by all",
    "multiloci_counts": f"select {' + '.join(f'''(case when coalesce({m}, '') <> '' then 1 else 0 end)''' for m in MARKERS)} as how_multiloci, count(*) as specimens from ({_MATRIX}) group by 1",
    "shared_value_clusters": f"{_CLUSTERS} select seq_no, cluster from c",
    "cluster_key": f"{_KEYS} select cluster, cluster_key from k",
    "alias_map": f"{_KEYS} select cluster_key, string_agg(distinct value, '|' order by value) as aliases from g join k using (cluster) group by 1",
    "code_to_cluster": f"""{_KEYS}, m as (select value, min(cluster_key) as key from g join k using (cluster) group by 1)
      select row_id, coalesce(key, value) as specimen, key is not null as known from (select distinct row_id, {_CODE.replace('specimen_voucher', 'voucher')} as value from gb_table_row where not {sql_absent('voucher')}) left join m using (value)""",
    "genus_counts": "select genus, count(*) as records, count(distinct species) as names from (select distinct seq_no, species, case when length(g) >= 3 and not ends_with(g, '.') then g end as genus from (select seq_no, species, split_part(trim(species), ' ', 1) as g from seq_record)) group by 1",
    "latest_stamp": "select max(cast(loaded_at as date))::varchar as latest from seq_record",
    "validate_voucher": f"""select split_part(d, '/', 1) as status, split_part(d, '/', 2) as reason, count(*) as n, count(distinct case when starts_with(d, 'accepted') then trim(voucher) end) as values from (
      select *, {_CASES} as d from (select distinct seq_no, gbn, specimen_voucher, {_ACC('gbn')} as acc from seq_record where gbn is not null) join (select distinct row_id, voucher, {_ACC('gb_its')} as acc from gb_table_row) using (acc)) group by 1, 2""",
    "validate_species": f"""select split_part(d, '/', 1) as status, split_part(d, '/', 2) as reason, count(*) as n from (select case when {_MISS('candidate', 'none')} then 'rejected/empty' when {_INCOMPLETE('candidate')} then 'rejected/candidate_incomplete'
      when not {_INCOMPLETE('species')} then 'deferred/existing_species_complete' when split_part(candidate, ' ', 1) not in (select split_part(species, ' ', 1) from type_registry where species is not null) then 'rejected/unknown_genus' else 'accepted/ok' end as d
      from (select distinct seq_no, gbn, species, {_ACC('gbn')} as acc from seq_record where gbn is not null) join (select distinct row_id, species as candidate, {_ACC('gb_its')} as acc from gb_table_row) using (acc)) group by 1, 2""",
    "apply_if_missing": f"""select seq_no, voucher from (select distinct seq_no, {_ACC('gbn')} as acc from seq_record where gbn is not null and {_MISS('specimen_voucher', 'none')})
      join (select {_ACC('gb_its')} as acc, arg_min(voucher, row_id) as voucher from gb_table_row where not {sql_absent('voucher')} group by 1) using (acc)""",
    "audit_append": "select distinct seq_no, case when host is null then type_material when type_material is null or type_material = host then host else host || '; ' || type_material end as audit from seq_record where coalesce(host, '') <> '' or coalesce(type_material, '') <> ''",
    "fallback_values": f"""select distinct acc, coalesce(g.c, d.c) as value, case when g.c is not null then 'table' else 'document' end as method from (select distinct {_ACC('gbn')} as acc from seq_record where gbn is not null and {sql_absent('geo_loc_name')})
      left join (select {_ACC('gb_its')} as acc, arg_min(country, row_id) as c from gb_table_row where not {sql_absent('country')} group by 1) g using (acc)
      left join (select {_ACC('accession')} as acc, arg_min(country, row_id) as c from doc_row where not {sql_absent('country')} group by 1) d using (acc) where coalesce(g.c, d.c) is not null""",
    "signature_diff": f"{_DIFF} select * from d",
    "diff_summary": f"{_DIFF} select change, count(*) as cells, count(distinct signature) as signatures from d group by 1",
    "type_label": f"""select case when regexp_matches(x, '\\bculture of') then 'ex-type' {' '.join(f"when regexp_matches(x, '\\b{k}\\b') then '{k}'" for k in ('holotype', 'isotype', 'paratype', 'neotype', 'lectotype', 'epitype', 'syntype', 'type'))} end as label, count(*) as records
      from (select distinct seq_no, lower(type_material) as x from seq_record where not {sql_absent('type_material')}) group by 1""",
}
