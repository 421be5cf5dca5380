"""Queries on what cells and tables of articles hold: token classes, countries, column types, records, fills."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions import tokens as K
from ..functions.missing import absent, sql_absent
from ..operators import articletables as A
from ..operators import cluster, frames, places, specimens
from ..session import table
from . import documents, specimens as records

_GENES = ("gb_its", "gb_lsu", "gb_ssu", "gb_tef1", "gb_rpb1", "gb_rpb2", "gb_beta_tubulin")


def _union(*dfs: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, dfs)


def _cells_of_rows(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """The distinct texts of the given columns of article table rows."""
    t = table(spark, sf, "gb_table_row")
    return _union(*[t.select(F.col(c).alias("x")) for c in columns])


def token_classes(spark, sf):
    """Every distinct line and cell of scanned and tabulated rows with what it looks like."""
    lines = table(spark, sf, "doc_row").select(F.explode("raw_row_lines").alias("x"))
    t = lines.union(_cells_of_rows(spark, sf, "species", "voucher", "country", "gb_its")).filter("x is not null").distinct()
    x = F.col("x")
    tests = {"accession": K.is_accession, "accession_or_dash": K.is_accession_or_dash, "citation": K.is_citation, "species": K.is_species, "genus": K.is_genus, "reference": K.is_reference, "voucher": K.is_voucher, "noise": K.is_noise, "gene_head": K.is_gene_head, "super_head": K.is_super_head}
    return t.select("x", *[f(x).alias(n) for n, f in tests.items()])


def species_candidates(spark, sf):
    """Distinct cells and title words that may be a species, or not."""
    title = table(spark, sf, "article").select(F.array_join(F.slice(F.split("title", " "), 1, 2), " ").alias("x"))
    t = _cells_of_rows(spark, sf, "species", "country").union(title).filter("x is not null").distinct()
    known = places.resolve(t, "x", table(spark, sf, "country_variant")).select(F.col("value").alias("x"), "country")
    return t.join(known, "x", "left").select("x", K.is_species_candidate(F.col("x"), F.col("country")).alias("candidate"))


def clause_vouchers(spark, sf):
    """Vouchers of the sections' clauses, series spelled out, months left out."""
    c = specimens.clauses(table(spark, sf, "section_block").select("section_id", "text").distinct(), "section_id", "text")
    return c.select("section_id", "pos", F.explode(specimens.clause_vouchers(F.col("clause"))).alias("voucher"))


def type_labels(spark, sf):
    """Type material labelled as ex-<kind> or <kind>, the first kind in order."""
    return records.seq(spark, sf, "type_material").filter("type_material is not null").select("seq_no", K.type_label(F.col("type_material")).alias("label"))


def file_guesses(spark, sf):
    """Supplement and article files: may they be loaded, and what they are."""
    names = table(spark, sf, "supp_record").select(F.col("file_name").alias("file")).union(table(spark, sf, "article").select("pdf_path")).union(table(spark, sf, "article").select("md_path"))
    f = F.col("file")
    return names.filter("file is not null").distinct().select("file", K.is_download(f).alias("loadable"), K.guessed_type(f).alias("kind"))


def row_codes(spark, sf):
    """Accessions in any column of article table rows, and the gene columns' values in order."""
    t = table(spark, sf, "gb_table_row").select("row_id", "species", "voucher", "country", *_GENES, "source_doi").distinct()
    everywhere = K.codes_of(*[F.col(c) for c in ("species", "voucher", "country", *_GENES, "source_doi")])
    return t.select("row_id", F.array_join(everywhere, "|").alias("codes"), F.array_join(K.marker_codes([F.col(g) for g in _GENES]), "|").alias("by_marker"))


def accession_candidates(spark, sf):
    """Accessions under which a record is looked up: as it stands, and without version."""
    t = records.seq(spark, sf, "gbn").filter("gbn is not null")
    return t.select("seq_no", F.posexplode(K.lookup_candidates(F.col("gbn"))).alias("pos", "candidate"))


def species_queries(spark, sf):
    """Genera under which names are searched in a registry, and cleaned names of table rows."""
    t = _cells_of_rows(spark, sf, "species").filter("x is not null").distinct()
    return t.select("x", K.query_genus(F.col("x")).alias("genus"), C.clean_species(F.col("x")).alias("cleaned"))


def country_resolved(spark, sf):
    """Country cells by name, alias, folded alias, code or base."""
    return places.resolve(_cells_of_rows(spark, sf, "country"), "x", table(spark, sf, "country_variant"))


def country_canonical(spark, sf):
    """Country cells by a lookup in any case, again without semicolons and slashes."""
    return places.canonical_name(_cells_of_rows(spark, sf, "country"), "x", table(spark, sf, "country_variant"))


def country_detected(spark, sf):
    """Registry localities and collecting places with the country or countries that they lie in."""
    t = table(spark, sf, "type_registry").select(F.col("locality_raw").alias("x")).union(table(spark, sf, "seq_record").select("geo_loc_name"))
    d = places.detect(t, "x", table(spark, sf, "country_variant"), table(spark, sf, "locality_cache"))
    return d.select("value", "country", F.array_join("choices", "|").alias("choices"), "how")


def country_extended(spark, sf):
    """Country cells and vouchers, resolved strictly and then by detection, guarded."""
    return places.resolve_extended(_cells_of_rows(spark, sf, "country", "voucher"), "x", table(spark, sf, "country_variant"), table(spark, sf, "locality_cache"))


def registry_countries(spark, sf):
    """Countries of records without one, by their voucher or an alias of it, from tables first and supplements second."""
    v = records._values(spark, sf)
    got = v.join(cluster.components(v, "seq_no", "value"), "seq_no")
    aliases = got.join(cluster.representative(got, "cluster", "value"), "cluster").select("cluster_key", F.col("value").alias("alias")).distinct()
    gaps = records.seq(spark, sf, "specimen_voucher", "geo_loc_name").filter(absent("geo_loc_name")).select("seq_no", "specimen_voucher")
    sources = [(n, table(spark, sf, t).select(F.col("voucher").alias("code"), "country")) for n, t in (("table", "gb_table_row"), ("supplement", "supp_record"))]
    return places.registry_country(gaps, "seq_no", "specimen_voucher", aliases, sources)


def _raw_cells(spark, sf):
    t = table(spark, sf, "gb_table_row").select("source_doi", "source_table_index", F.col("row_id").alias("r"), F.explode("raw_row").alias("header", "value"))
    return t.filter("source_doi is not null and source_table_index is not null").distinct()


_TABLE = ["source_doi", "source_table_index"]


def column_types(spark, sf):
    """Types of the raw tables' columns; gene columns are told by their values here."""
    words = {k: A.COLUMN_WORDS[k] for k in ("species", "voucher", "country")}
    return A.column_types(_raw_cells(spark, sf), _TABLE, words)


def table_records(spark, sf):
    """The raw tables' rows as records with their accessions."""
    c = _raw_cells(spark, sf)
    return A.records(c, _TABLE, A.column_types(c, _TABLE)).select(*_TABLE, F.col("r").alias("row_id"), "species", "voucher", "country", F.array_join("codes", "|").alias("codes"))


def sampled_values(spark, sf):
    """The first ten present values of each raw column."""
    return A.sampled(_raw_cells(spark, sf), _TABLE).select(*_TABLE, "header", F.col("n").cast("int").alias("n"), "value")


def merged_rows(spark, sf):
    """Raw rows that seem to hold several records."""
    return A.merged_rows(_raw_cells(spark, sf), _TABLE).select(*_TABLE, F.col("r").alias("row_id"))


def fill_species_down(spark, sf):
    """Table rows with blank species taking the name above; rows of a name alone open a group."""
    t = table(spark, sf, "gb_table_row").select("row_id", *_TABLE, "species", "voucher", "gb_its", "gb_lsu").distinct()
    x = A.filled_down(t, _TABLE, "row_id", "species", "voucher", ["gb_its", "gb_lsu"], F.floor(F.col("row_id") / 65536))
    return x.select("row_id", "species", "voucher", "filled")


def best_headers(spark, sf):
    """The table of each article with the most gene columns in use."""
    t = table(spark, sf, "gb_table_row").filter("source_doi is not null and source_table_index is not null")
    used = F.array_sort(F.collect_set(F.col("g.name")))
    g = F.explode(F.array(*[F.struct(F.lit(c.removeprefix("gb_")).alias("name"), F.col(c).alias("v")) for c in _GENES])).alias("g")
    heads = t.select(*_TABLE, g).filter("g.v is not null").groupBy(*_TABLE).agg(used.alias("genes"))
    return A.best_header(heads, ["source_doi"], "source_table_index", "genes").select("source_doi", "source_table_index", F.array_join("genes", "|").alias("genes"))


def prose_fill(spark, sf):
    """Table rows without a country and what their article's prose says of their voucher: applied, ambiguous, no_pair or no_document."""
    rows = table(spark, sf, "gb_table_row").filter(absent("country") & ~absent("voucher")).select("row_id", "source_doi", C.code_key_prose(F.col("voucher")).alias("code")).distinct()
    docs = table(spark, sf, "article").select(F.col("doi").alias("source_doi"), F.col("pdf_path").alias("pdf")).filter("pdf is not null").distinct()
    s = table(spark, sf, "section_block").select("section_id", "pdf").distinct()
    pairs = documents.section_pairs(spark, sf).join(s, "section_id").select("pdf", C.code_key_prose(F.col("voucher")).alias("code"), "country")
    said = frames.unanimous(pairs, ["pdf", "code"], "country")
    have = s.select("pdf", F.lit(True).alias("have")).distinct()
    x = rows.join(docs, "source_doi", "left").join(have, "pdf", "left").join(said, ["pdf", "code"], "left")
    status = F.coalesce("status", F.when(F.col("have"), "no_pair").otherwise("no_document"))
    return x.select("row_id", status.alias("status"), "value", F.coalesce("choices", F.lit("")).alias("choices"))


def markers_present(spark: SparkSession, sf: str) -> list[str]:
    """The markers that occur, sorted; their number is that of the marker dictionary at most."""
    from ..operators.matrix import marker_of

    found = table(spark, sf, "seq_record").select(marker_of(F.col("description")).alias("m")).filter("m is not null").distinct()
    return sorted(r["m"] for r in found.collect())


def specimen_matrix_wide(spark, sf):
    """The specimen matrix with a column and a sequence column for each marker that occurs."""
    from ..operators.matrix import marker_of, wide_matrix

    t = records._keyed(spark, sf, "species", "geo_loc_name", "host", "type_material", "title", "description", "seq_text").withColumn("marker", marker_of(F.col("description")))
    return wide_matrix(t, "code", ["species", "geo_loc_name", "host", "type_material", "title"], "marker", "gbn", "seq_text", "seq_no", markers_present(spark, sf))


def registry_records(spark, sf):
    """Registry answers assembled into records: types, status, own basionym and current name dropped, host without tags."""
    from ..functions.registry import record

    t = table(spark, sf, "type_registry").dropDuplicates()
    got = places.detect(t, "locality_raw", table(spark, sf, "country_variant"), table(spark, sf, "locality_cache")).select(F.col("value").alias("locality_raw"), F.col("country").alias("found"))
    r = record(**{k: F.col(k) for k in ("record_id", "species", "host", "typification", "basionym_record_id", "name_status", "current_name", "current_name_id")})
    x = t.join(got, "locality_raw", "left").select("record_id", r.alias("r"), F.coalesce("found", F.lit("")).alias("country"))
    return x.select("record_id", "r.species", "r.host", "r.basionym", "r.status", "r.current_name", "r.current_id", F.size("r.types").alias("types"), "country")


QUERIES = {f.__name__: f for f in (token_classes, species_candidates, clause_vouchers, type_labels, file_guesses, row_codes, accession_candidates, species_queries, country_resolved, country_canonical, country_detected, country_extended, registry_countries, column_types, table_records, sampled_values, merged_rows, fill_species_down, best_headers, prose_fill, specimen_matrix_wide, registry_records)}

# ---- oracles -----------------------------------------------------------------------------------------

_CELLS = lambda *cs: "(select distinct x from (" + " union all ".join(f"select {c} as x from gb_table_row" for c in cs) + ") where x is not null)"
_ANY = lambda forms: "|".join(forms).replace("'", "''")
_BARE = lambda c: f"upper(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim({c}), '^[()\\[\\]{{}}<>,;:]+|[()\\[\\]{{}}<>,;:]+$', '', 'g'), '^[.,;:]+|[.,;:]+$', '', 'g'), '[*†‡§a-z]+$', ''), '\\.\\d+$', ''))"
_ACC = lambda c: f"regexp_matches({_BARE(c)}, '^([A-Z][0-9]{{5}}|[A-Z]{{2}}[0-9]{{6,8}})$')"
_DASH = lambda c: f"regexp_matches(trim({c}), '^[–—-]+$')"
_STARTS = lambda c, forms: f"regexp_matches(trim({c}), '^({_ANY(forms)})')"
_ISREF = lambda c: f"regexp_matches(trim({c}), '{_ANY(K.REFERENCES)}')"
_QUOTES = "[\"''‘’‛“”„‟′″`]+"
_IN = lambda words: "(" + ", ".join(f"'{w}'" for w in words) + ")"
_FOLD = documents._FOLD
_SHORT = "regexp_matches(spelling, '^[A-Za-z]{2,3}$')"
_KEYS = f"""(select kind, key, arg_max(country, (ord, country)) as country from (select 'name' as kind, lower(country) as key, country, 0 as ord from country_variant
  union all select 'alias', lower(spelling), country, ord from country_variant where not {_SHORT} union all select 'code', upper(spelling), country, ord from country_variant where {_SHORT}) group by 1, 2)"""


def _resolve_sql(source: str) -> str:
    """SQL of ``places.resolve`` over ``source`` (x)."""
    base = "trim(regexp_extract(trim(x), '^([A-Za-z .]+?)\\s*\\(', 1))"
    steps = [("name", "name", "lower(trim(x))", "true"), ("alias", "alias", "lower(trim(x))", "true"), ("folded", "alias", _FOLD("trim(x)"), f"{_FOLD('trim(x)')} <> lower(trim(x))"), ("code", "code", "trim(x)", "regexp_matches(trim(x), '^[A-Z]{2,3}$')"), ("base", "name", f"lower({base})", f"{base} <> ''"), ("base", "alias", f"lower({base})", f"{base} <> ''"), ("base", "code", base, f"regexp_matches({base}, '^[A-Z]{{2,3}}$')")]
    tries = " union all ".join(f"select x as value, {i} as step, '{how}' as how, '{kind}' as kind, {key} as key from {source} where {when}" for i, (how, kind, key, when) in enumerate(steps))
    return f"(select value, arg_min(country, step) as country, arg_min(how, step) as how from ({tries}) join {_KEYS} using (kind, key) group by 1)"


def _canonical_sql(source: str) -> str:
    again = "trim(regexp_replace(regexp_replace(trim(x), '[;/]', ' ', 'g'), '[ \\t\\n\\r\\f]+', ' ', 'g'))"
    steps = [(how, kind, f"{'upper' if kind == 'code' else 'lower'}({v})") for how, v in (("plain", "trim(x)"), ("cleaned", again)) for kind in ("name", "alias", "code")]
    tries = " union all ".join(f"select x as value, {i} as step, '{how}' as how, '{kind}' as kind, {key} as key from {source}" for i, (how, kind, key) in enumerate(steps))
    return f"(select value, arg_min(country, step) as country, arg_min(how, step) as how from ({tries}) join {_KEYS} using (kind, key) group by 1)"


def _detect_sql(source: str) -> str:
    """SQL of ``places.detect`` over ``source`` (x), without a geocoder."""
    head = "trim(regexp_extract(x, '(?is)^(.*?)(?:page|position|citations|published|$)', 1))"
    v = f"(select x as value, {head} as head, trim(replace({_FOLD(head)}, ',', ' ')) as norm, trim({_FOLD(head)}) as place from {source} where x is not null)"
    words = f"(select value, list_filter(regexp_split_to_array(norm, '[ \\t\\n\\r\\f\\v]+'), lambda w: w <> '') as w from {v})"
    each = f"""select value, 0 as tier, 0 as pos, lower(head) as key from {v} union all select value, 1, 0, norm from {v}
      union all select value, 2, i, w[i + 1] || ' ' || w[i + 2] from (select value, w, unnest(range(0, len(w) - 1)) as i from {words}) union all select value, 3, i, w[i + 1] from (select value, w, unnest(range(0, len(w))) as i from {words})"""
    named = f"(select value, arg_min(country, (tier, pos, country)) as named from ({each}) join (select key, country from {_KEYS} where kind <> 'code') using (key) group by 1)"
    cache = "(select locality_norm as place, list_sort(list_distinct(countries)) as cached from locality_cache where len(countries) > 0)"
    choices = "coalesce(cached, case when named is not null then [named] end)"
    return f"(select value, case when len({choices}) = 1 then {choices}[1] end as country, array_to_string({choices}, '|') as choices, case when cached is not null then 'cache' else 'text' end as how from (from {v} where head <> '') left join {cache} using (place) left join {named} using (value) where {choices} is not null)"


_N3 = lambda c: f"lower(regexp_replace(trim({c}), '[\\s:\\-_,.;()\\[\\]{{}}]', '', 'g'))"
_PRESENT = lambda c: f"lower(trim(coalesce({c}, ''))) not in ('', '-', 'nan', 'none', 'n/a')"
_RAW = "(select distinct source_doi, source_table_index, row_id, h.key as header, h.value as value from (select source_doi, source_table_index, row_id, unnest(map_entries(raw_row)) as h from gb_table_row where source_doi is not null and source_table_index is not null))"
_HEAD = lambda kinds: "case " + " ".join(f"when {' or '.join(f'''contains(lower(trim(header)), '{w}')''' for w in A.COLUMN_WORDS[k])} then '{k}'" for k in kinds) + " end"
_SAMPLED = f"(select *, row_number() over (partition by source_doi, source_table_index, header order by row_id, value)::int as n from {_RAW} where {_PRESENT('value')} qualify n <= 10)"


def _types_sql(kinds) -> str:
    return f"""(select source_doi, source_table_index, header, coalesce(h, case when acc >= 3 then 'accession' end) as field, case when h is not null then 'header' else 'values' end as how from (select distinct source_doi, source_table_index, header, {_HEAD(kinds)} as h from {_RAW})
      left join (select source_doi, source_table_index, header, count_if(regexp_matches(trim(value), '^[A-Z]{{1,3}}[0-9]{{5,8}}(\\.[0-9]+)?$')) as acc from {_SAMPLED} group by all) using (source_doi, source_table_index, header) where coalesce(h, case when acc >= 3 then 'accession' end) is not null)"""


_CODE = documents._N4("name || ' ' || n")
_WIDE = ("ITS", "LSU", "RPB1", "RPB2", "SSU", "TEF1")
_LAST = lambda f: f"arg_max(trim(value), header) filter (where field = '{f}') as {f}"
_NAMED = "regexp_matches(v, '^[A-Z][a-z]*\\.?\\s+[a-z]+')"
_CODED = f"(regexp_matches(v, '^[A-Z]{{2,6}}[- ]?[0-9]+|^[A-Z][a-z]+\\s+[0-9]+') and not {_NAMED})"

SQL = {
    "token_classes": f"""select x, coalesce({_ACC('x')}, false) as accession, {_DASH('x')} or {_ACC('x')} or len(list_filter(regexp_split_to_array(trim(x), '[ \\t\\n\\r\\f\\v]+'), lambda w: {_ACC('w')})) = 1 as accession_or_dash,
      regexp_matches(trim(x), '^\\[\\s*\\d+(\\s*[-,]\\s*\\d+)*\\s*\\]$') as citation, {_STARTS(f"regexp_replace(x, '{_QUOTES}', '', 'g')", K.SPECIES)} as species, regexp_matches(trim(x), '^[A-Z][a-z]{{3,}}$') as genus, {_ISREF('x')} as reference,
      {_STARTS('x', K.VOUCHERS)} and not {_ISREF('x')} as voucher, {_STARTS('lower(x)', K.NOISE)} as noise, lower(trim(x)) in {_IN(K.GENE_HEADS)} as gene_head, regexp_matches(lower(trim(x)), '^(genbank\\s+accession|accession\\s+number|accession\\s+no\\w*$)') as super_head
      from (select distinct x from (select unnest(raw_row_lines) as x from doc_row union all select x from {_CELLS('species', 'voucher', 'country', 'gb_its')}) where x is not null)""",
    "species_candidates": f"""with t as (select distinct x from (select x from {_CELLS('species', 'country')} union all select array_to_string(string_split(title, ' ')[1:2], ' ') from article) where x is not null),
      w as (select x, regexp_split_to_array(lower(trim(x)), '[ \\t\\n\\r\\f\\v]+') as w from t), p as (select x, len(w) as n, regexp_replace(w[1], '\\.+$', '') as a, regexp_replace(coalesce(w[2], ''), '[.,;:]+$', '') as b from w)
      select x, a <> '' and a not in {_IN(K.NO_GENUS)} and r.country is null and b not in {_IN(K.NO_EPITHET)} and not (n = 2 and regexp_matches(b, '^(19|20)[0-9]{{2}}$')) and not (regexp_matches(a, '(aceae|ales)$') and not starts_with(b, 'sp')) as candidate
      from p left join {_resolve_sql('t')} r on r.value = x""",
    "clause_vouchers": f"select section_id, pos, arg_min(name || ' ' || n, (o, p, q)) as voucher from {documents._HITS} where lower(regexp_replace(name, '[^A-Za-z]', '', 'g')) not in {_IN(('', *K.NO_COLLECTOR))} group by section_id, pos, {_CODE}",
    "type_labels": "select seq_no, case " + " ".join(f"when regexp_matches(t, '(culture|isolate)\\s+(from|of)\\s+(the\\s+)?{k}') then 'ex-{k}'" for k in K.TYPE_KINDS) + " " + " ".join(f"when regexp_matches(t, '{k}\\s+of') then '{k}'" for k in K.TYPE_KINDS) + " end as label from (select distinct seq_no, lower(type_material) as t from seq_record where type_material is not null)",
    "file_guesses": """select file, regexp_matches(f, '\\.(xlsx?|docx?|pdf|csv|zip|txt)') as loadable, case when f like '%.xls%' then 'excel' when f like '%.doc%' then 'word' when f like '%.pdf%' then 'pdf' when f like '%.csv%' then 'csv' when f like '%.zip%' then 'zip' else 'unknown' end as kind
      from (select distinct file, lower(file) as f from (select file_name as file from supp_record union all select pdf_path from article union all select md_path from article) where file is not null)""",
    "row_codes": f"""with t as (select distinct row_id, species, voucher, country, {', '.join(_GENES)}, source_doi from gb_table_row), w as (select t.*, list_filter(list_transform(flatten(list_transform([species, voucher, country, {', '.join(_GENES)}, source_doi], lambda v: regexp_split_to_array(coalesce(v, ''), '[|,;\\s]+'))), lambda x: regexp_replace(x, '[()\\[\\]{{}}]', '', 'g')), lambda x: regexp_matches(x, '(?i)^[A-Z]{{1,3}}[0-9]{{5,8}}(\\.[0-9]+)?$')) as l from t)
      select row_id, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), '|') as codes, array_to_string(list_filter(list_transform([{', '.join(_GENES)}], lambda v: trim(v)), lambda v: length(v) >= 6 and regexp_matches(v, '^\\pL')), '|') as by_marker from w""",
    "accession_candidates": "select seq_no, 0 as pos, trim(gbn) as candidate from (select distinct seq_no, gbn from seq_record where trim(gbn) <> '') union all select seq_no, 1, split_part(trim(gbn), '.', 1) from (select distinct seq_no, gbn from seq_record where trim(gbn) <> '') where split_part(trim(gbn), '.', 1) <> trim(gbn)",
    "species_queries": f"""with t as (select x, regexp_split_to_array(trim(x), '[ \\t\\n\\r\\f\\v]+')[1] as f, trim(x) as t from {_CELLS('species')})
      select x, case when length(regexp_replace(f, '^[.,;:()\\[\\]{{}}]+|[.,;:()\\[\\]{{}}]+$', '', 'g')) > 2 and not regexp_matches(f, '^[A-Za-z]{{1,2}}\\.$') then regexp_replace(f, '^[.,;:()\\[\\]{{}}]+|[.,;:()\\[\\]{{}}]+$', '', 'g') end as genus,
      coalesce({', '.join(f"nullif(regexp_extract(x, '{p}', 1), '')" for p in (r'^([A-Z][a-z]*[.]? (?:cf[.]|aff[.]) [a-z-]+)', r'^([A-Z][a-z]*[.]? sp[.](?: [IVX0-9]+)?(?: [(]sect[.] [A-Za-z]+[)])?)', r'^([A-Z][a-z]*[.]? [a-z-]+ (?:subsp[.]|var[.]|f[.]) [a-z-]+)', r'^([A-Z][a-z]*[.]? [a-z-]{3,})'))}, t) as cleaned from t""",
    "country_resolved": f"select * from {_resolve_sql(_CELLS('country'))}",
    "country_canonical": f"select * from {_canonical_sql(_CELLS('country'))}",
    "country_detected": f"select * from {_detect_sql('(select distinct x from (select locality_raw as x from type_registry union all select geo_loc_name from seq_record))')}",
    "country_extended": f"""with t as materialized (from {_CELLS('country', 'voucher')}), s as materialized (from {_resolve_sql('t')}), g as materialized (select x from t where x not in (select value from s) and length(trim(x)) >= 2 and not {_ACC('x')} and not {_STARTS('x', K.VOUCHERS)}
        and not {_STARTS(f"regexp_replace(x, '{_QUOTES}', '', 'g')", K.SPECIES)} and not regexp_matches(trim(x), '^[0-9]+$') and not (regexp_matches(trim(x), '[A-Z]{{2,}}\\s*[0-9]') and not regexp_matches(trim(x), '(?i)rep[.]|republic')))
      select value, country, how from s union all select value, country, 'detected' from {_detect_sql('g')} where country is not null""",
    "registry_countries": f"""{records._KEYS}, al as materialized (select distinct cluster_key, value as alias from g join k using (cluster)), gaps as (select distinct seq_no, trim(specimen_voucher) as own from seq_record where {sql_absent('geo_loc_name')} and not {sql_absent('specimen_voucher')}),
      mem as (select k3, min(cluster_key) as cluster_key from (select cluster_key, {_N3('alias')} as k3 from al union select cluster_key, {_N3('cluster_key')} from al) group by 1),
      cand as (select seq_no, 0 as pos, own as c from gaps union all select seq_no, 1, cluster_key from gaps join mem on k3 = {_N3('own')} union all select seq_no, 1 + row_number() over (partition by seq_no order by alias), alias from gaps join mem on k3 = {_N3('own')} join al using (cluster_key)),
      src as (select {_N3('voucher')} as k3, min(country) as country, 'table' as source, 0 as place from gb_table_row where not {sql_absent('voucher')} and not {sql_absent('country')} group by 1 union all select {_N3('voucher')}, min(country), 'supplement', 1 from supp_record where not {sql_absent('voucher')} and not {sql_absent('country')} group by 1)
      select seq_no, arg_min(country, (pos, place)) as country, arg_min(source, (pos, place)) as source, arg_min(c, (pos, place)) as matched from cand join src on k3 = {_N3('c')} where {_N3('c')} <> '' group by 1""",
    "column_types": f"select * from {_types_sql(('species', 'voucher', 'country'))}",
    "table_records": f"""select source_doi, source_table_index, row_id, {_LAST('species')}, {_LAST('voucher')}, {_LAST('country')}, string_agg(distinct field || '=' || trim(value), '|' order by field || '=' || trim(value)) filter (where (starts_with(field, 'gb_') or field = 'accession') and regexp_matches(trim(value), '^[A-Z]{{1,3}}[0-9]{{5,8}}(\\.[0-9]+)?$')) as codes
      from {_RAW} join {_types_sql(A.COLUMN_WORDS)} using (source_doi, source_table_index, header) where {_PRESENT('value')} group by 1, 2, 3 having codes is not null""",
    "sampled_values": f"select source_doi, source_table_index, header, n, value from {_SAMPLED}",
    "merged_rows": f"""select distinct source_doi, source_table_index, row_id from {_RAW} where len(regexp_extract_all(value, '\\b[A-Z]{{1,2}}[0-9]{{5,8}}\\b')) >= 2 and not regexp_matches(lower(header), 'its|lsu|tef|rpb') or len(regexp_extract_all(value, '[A-Z][a-z]*\\s*[0-9]+')) >= 2 and contains(value, ' ')""",
    "fill_species_down": f"""with t as (select distinct row_id, source_doi, source_table_index, trim(coalesce(species, '')) as v, voucher, {_PRESENT('voucher')} or {_PRESENT('gb_its')} or {_PRESENT('gb_lsu')} as beside from gb_table_row),
      f as (select *, last_value(case when {_NAMED} then v end ignore nulls) over (partition by source_doi, source_table_index order by row_id rows between unbounded preceding and current row) as above from t where not (contains(lower(v), 'voucher') and contains(lower(v), 'reference'))),
      g as (select *, not {_NAMED} and above is not null and (not {_PRESENT('v')} or {_CODED} or beside) as filled from f where not ({_NAMED} and not beside))
      select row_id, case when filled then above else v end as species, case when filled and {_PRESENT('v')} and not {_PRESENT('voucher')} then v else voucher end as voucher, filled from g""",
    "best_headers": f"""with h as (select source_doi, source_table_index, list_sort(list_distinct(list(g))) as genes from (select source_doi, source_table_index, unnest([{', '.join(f"case when {g} is not null then '{g.removeprefix('gb_')}' end" for g in _GENES)}]) as g from gb_table_row where source_doi is not null and source_table_index is not null) where g is not null group by 1, 2),
      r as (select *, len(list_filter(genes, lambda g: regexp_matches(lower(g), 'its|lsu|ssu|tef|rpb|btub|28s|18s|accession'))) > 0 as ok from h) select source_doi, arg_max(source_table_index, k) as source_table_index, array_to_string(arg_max(genes, k), '|') as genes from (select *, (ok, case when ok then len(genes) else 0 end, -source_table_index) as k from r) group by 1""",
    "prose_fill": f"""with p as materialized (select pdf, {documents._N4('voucher')} as code, country from {documents._PAIRS} join (select distinct section_id, pdf from section_block) using (section_id)), u as (select pdf, code, list_sort(list_distinct(list(country))) as cs from p where lower(trim(country)) not in ('', 'nan', 'none') group by 1, 2)
      select row_id, case when cs is not null then case when len(cs) = 1 then 'applied' else 'ambiguous' end when h.pdf is not null then 'no_pair' else 'no_document' end as status, case when len(cs) = 1 then cs[1] end as value, coalesce(array_to_string(cs, '|'), '') as choices
      from (select distinct row_id, source_doi, {documents._N4('voucher')} as code from gb_table_row where {sql_absent('country')} and not {sql_absent('voucher')}) r left join (select distinct doi as source_doi, pdf_path as pdf from article where pdf_path is not null) d using (source_doi)
      left join (select distinct pdf from section_block) h on h.pdf = d.pdf left join u on u.pdf = d.pdf and u.code = r.code""",
    "specimen_matrix_wide": f"""select code, {', '.join(map(records._SET, ('species', 'geo_loc_name', 'host', 'type_material', 'title')))}, {', '.join(f"arg_max(gbn, seq_no) filter (where marker = '{m}') as {m}, arg_max(seq_text, seq_no) filter (where marker = '{m}') as seq{m}" for m in _WIDE)},
      {' + '.join(f"(case when count(gbn) filter (where marker = '{m}' and gbn <> '') > 0 and coalesce(arg_max(gbn, seq_no) filter (where marker = '{m}'), '') <> '' then 1 else 0 end)" for m in _WIDE)} as how_multiloci from {records._KEYED.replace('type_material,', 'type_material, title, seq_text,')} group by code""",
    "registry_records": f"""select record_id, species, trim(regexp_replace(coalesce(host, ''), '<[^>]+>', '', 'g')) as host, case when basionym_record_id = record_id then '' else coalesce(basionym_record_id, '') end as basionym, s as status, case when s in ('synonym', 'orthographic_variant') then coalesce(trim(current_name), '') else '' end as current_name,
      case when s in ('synonym', 'orthographic_variant') then coalesce(trim(current_name_id), '') else '' end as current_id, types, coalesce(c.country, '') as country from (select *, case when name_status = 'Invalid' then 'invalid' when name_status = 'Orthographic variant' then 'orthographic_variant' when trim(current_name_id) = record_id then 'accepted' when coalesce(trim(current_name), '') <> '' then 'synonym' else 'unresolved' end as s,
      case when t = '' then 0 else greatest(1, len(regexp_extract_all(t, '(?i)\\b(holotype|isotype|paratype|neotype|lectotype|epitype|isolectotype|syntype)s?\\b'))) end as types from (select distinct on (record_id) * exclude country, trim(regexp_replace(regexp_replace(coalesce(typification, ''), '^Typification:\\s*', ''), '(?i)\\(designated by[^)]*\\)?', '', 'g')) as t from type_registry)) r left join {_detect_sql('(select distinct locality_raw as x from type_registry)')} c on c.value = r.locality_raw""",
}
