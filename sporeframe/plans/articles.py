"""Queries on articles, article tables, occurrence rows and the registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions import registry as R
from ..functions import text as T
from ..functions.missing import absent, missing, sql_absent
from ..operators import frames, matrix, prose, unpack
from ..session import table

#: Journals of the test tables by the prefix of their DOIs.
JOURNALS = (("mycox", "10.99872"), ("verandian", "10.99871"), ("polypore", "10.99873"), ("sheets", "10.99874"))
_MISS = lambda c: f"(coalesce(lower(trim({c})), '') in ('', 'nan', 'none'))"
_VERSIONLESS = lambda c: f"upper(regexp_replace(trim({c}), '\\.\\d+$', ''))"


def _rows(spark, sf, *columns):
    return table(spark, sf, "gb_table_row").select("row_id", *columns).distinct()


def _acc(c):
    return F.upper(C.without_version(F.trim(c)))


#: Columns of an article table row that hold accessions.
_GB = ("gb_its", "gb_lsu", "gb_ssu", "gb_tef1", "gb_rpb1", "gb_rpb2", "gb_beta_tubulin")


def _cells():
    """The distinct accessions of a row's gene columns; case, blanks and version aside. Cells without a digit (dashes, fillers) hold none."""
    x = F.transform(F.array(*_GB), lambda c: F.upper(C.without_version(F.regexp_replace(c, r"\s+", ""))))
    return F.array_distinct(F.filter(x, lambda c: c.rlike("[0-9]")))


def article_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """For each article: distinct species, vouchers and countries of its rows, and the accessions of all genes."""
    t = _rows(spark, sf, "source_doi", "species", "voucher", "country", *_GB).withColumn("accs", _cells())
    g = t.groupBy("source_doi").agg(matrix.joined_set(F.col("species")).alias("species"), matrix.joined_set(F.col("voucher")).alias("vouchers"), matrix.joined_set(F.col("country")).alias("countries"), F.count("*").alias("rows"))
    n = t.select(F.col("source_doi").alias("d"), F.explode("accs").alias("a")).groupBy("d").agg(F.count_distinct("a").alias("n"))
    return g.join(n, F.col("source_doi").eqNullSafe(F.col("d")), "left").select("source_doi", "species", "vouchers", "countries", F.coalesce("n", F.lit(0)).alias("accessions"), "rows")


def article_lookup(spark, sf):
    """The first article (by doi) and the first row of it that hold an accession in any gene column."""
    t = _rows(spark, sf, "source_doi", "species", "voucher", "country", *_GB).filter("source_doi is not null").withColumn("accession", F.explode(_cells()))
    return t.groupBy("accession").agg(F.min_by(F.struct("source_doi", "species", "voucher", "country"), F.struct("source_doi", "row_id")).alias("m")).select("accession", "m.*")


def _listed(spark, sf):
    """``(accession, doi)``: the accessions of each article's list, packed elements split; versions aside."""
    x = unpack.unpack(table(spark, sf, "article"), "article.gb_accessions", "doi", "gb_accessions", "codes", 1)
    return x.filter("row_key is not null").select(_acc("item").alias("accession"), F.col("row_key").alias("doi"))


def article_of_accession(spark, sf):
    """Accessions of the sequence records with the first article whose list holds them, alone or packed with others; versions aside."""
    a = _listed(spark, sf)
    s = table(spark, sf, "seq_record").filter("gbn is not null").select(_acc("gbn").alias("accession")).distinct()
    return s.join(a.groupBy("accession").agg(F.min("doi").alias("doi")), "accession")


def article_stats(spark, sf):
    a = table(spark, sf, "article")
    return a.agg(F.count("*").alias("articles"), F.count_if("has_gb_table").alias("with_table"), F.count_if("has_supplementary").alias("with_supplement"), F.count_if("pdf_downloaded").alias("downloaded"), F.sum(F.coalesce(F.size("gb_accessions"), F.lit(0))).alias("total_codes"))


def doi_names(spark, sf):
    """Store keys of the articles: hash, file name and publisher."""
    return table(spark, sf, "article").select("doi", F.md5("doi").alias("doi_hash"), R.pdf_name(F.col("doi")).alias("pdf"), R.publisher(F.col("doi"), JOURNALS).alias("publisher"))


def species_union(spark, sf):
    """Species that an article mentions or tabulates, as one ordered set."""
    g = _rows(spark, sf, "source_doi", "species").filter(~absent("species")).groupBy(F.col("source_doi").alias("doi")).agg(F.collect_set("species").alias("more"))
    none = F.array().cast("array<string>")
    a = table(spark, sf, "article").select("doi", F.coalesce("species_mentioned", none).alias("own")).join(g, "doi", "left")
    both = F.array_sort(F.filter(F.array_union("own", F.coalesce("more", none)), lambda x: x.isNotNull()))
    return a.select("doi", F.array_join(both, "|").alias("species"), F.size(both).alias("n"))


def title_parse(spark, sf):
    t = table(spark, sf, "seq_record").select("seq_no", "title").distinct()
    return t.select("seq_no", F.posexplode(C.title_parts(F.col("title"))).alias("pos", "title"))


def title_jaccard(spark, sf):
    """Article titles of one journal and year that share at least 60 % of their words.

    Prefix filter: sets that alike share one of each set's rarest words, as many as may be missing plus one.
    """
    w = F.array_distinct(F.split(F.lower(F.regexp_replace("title", "[^A-Za-z]+", " ")), " +"))
    a = table(spark, sf, "article").filter("title is not null and journal is not null and pub_year is not null").select("doi", "journal", "pub_year", w.alias("w"))
    each = a.select("doi", F.explode("w").alias("t"))
    often = each.groupBy("t").agg(F.count("*").alias("df"))
    rare = each.join(often, "t").groupBy("doi").agg(F.transform(F.array_sort(F.collect_list(F.struct("df", "t"))), lambda x: x["t"]).alias("r"))
    head = rare.select("doi", F.explode(F.slice("r", F.lit(1), (F.size("r") - F.ceil(F.size("r") * F.lit(0.6)) + 1).cast("int"))).alias("t")).join(a.select("doi", "journal", "pub_year"), "doi")
    x, y = head.withColumnRenamed("doi", "doi_a"), head.withColumnRenamed("doi", "doi_b")
    pairs = x.join(y, ["journal", "pub_year", "t"]).filter("doi_a < doi_b").select("doi_a", "doi_b").distinct()
    j = pairs.join(a.select(F.col("doi").alias("doi_a"), F.col("w").alias("u")), "doi_a").join(a.select(F.col("doi").alias("doi_b"), F.col("w").alias("v")), "doi_b")
    return j.select("doi_a", "doi_b", T.jaccard_sizes(F.col("u"), F.col("v")).alias("s")).select("doi_a", "doi_b", "s.common", "s.all").filter("common * 10 >= all * 6")


def forward_fill(spark, sf):
    """The species column of an article table with blank cells taking the last species above."""
    t = _rows(spark, sf, "source_doi", "source_table_index", "species")
    x = prose.carry(t, ["source_doi", "source_table_index"], "row_id", F.when(~absent("species"), F.col("species")), "filled", F.floor(F.col("row_id") / 65536))
    return x.select("row_id", "filled", absent("species").alias("was_blank"))


def unanimous_fill(spark, sf):
    """Country of a specimen code inside an article, if all its rows agree."""
    t = _rows(spark, sf, "source_doi", "voucher", "country").filter(~absent("voucher")).withColumn("code", C.code_key_prose(F.col("voucher")))
    return frames.unanimous(t, ["source_doi", "code"], "country")


def first_non_missing_merge(spark, sf):
    """Rows of one article and accession merged; the first present value of each column stays."""
    t = _rows(spark, sf, "source_doi", "gb_its", "species", "voucher", "country", "gb_lsu").filter("gb_its is not null").withColumn("key", F.concat_ws("#", "source_doi", _acc("gb_its")))
    return frames.first_present(t, "key", "row_id", ["species", "voucher", "country", "gb_lsu"])


def long_table_fields(spark, sf):
    """Cells of raw table rows as fields, by header aliases in order; unknown headers stay as other."""
    alias = F.create_map(*[F.lit(x) for kv in _ALIASES for x in kv])
    t = table(spark, sf, "gb_table_row").select("row_id", F.explode("raw_row").alias("header", "value")).distinct()
    return t.filter(~absent("value")).groupBy("header", F.coalesce(F.element_at(alias, F.lower("header")), F.lit("other")).alias("field")).agg(F.count("*").alias("cells"), F.count_distinct("value").alias("values"))


_ALIASES = (("taxon", "species"), ("species", "species"), ("collection no.", "voucher"), ("voucher", "voucher"), ("specimen no.", "voucher"), ("origin", "country"), ("country", "country"), ("its", "gb_its"), ("lsu", "gb_lsu"))


def transpose_tables(spark, sf):
    """Raw rows as cells with rows and columns swapped."""
    t = table(spark, sf, "gb_table_row").select("row_id", F.explode("raw_row").alias("header", "value")).distinct()
    c = prose.transpose_cells(t.select(F.lit("raw").alias("tab"), F.col("row_id").cast("string").alias("r"), F.col("header").alias("c"), "value"), "tab", "r", "c")
    return c.select("r", "c", "value")


def expand_merged(spark, sf):
    """Cells that hold several specimen codes, one row a code, numbered."""
    t = _rows(spark, sf, "voucher").filter("voucher is not null")
    return t.select("row_id", F.posexplode(F.transform(F.split("voucher", r"\s*[,=:]\s*|\s*\("), lambda v: F.trim(F.regexp_replace(v, r"\)$", "")))).alias("pos", "code")).filter("code <> ''")


def resolve_alias_chain(spark, sf):
    """Country cells by exact name, spelling, ISO code or the part before a bracket, in this order."""
    v = table(spark, sf, "country_variant")
    names = F.broadcast(v.select(F.lower("country").alias("k"), F.col("country").alias("c")).distinct())
    alias = F.broadcast(v.groupBy(F.col("spelling").alias("k")).agg(F.max_by("country", "ord").alias("c")))
    t = _rows(spark, sf, "country").filter(~absent("country")).withColumn("x", F.lower(F.trim("country"))).withColumn("y", F.trim(F.regexp_replace("x", r"\(.*$", "")))
    a, b, c = (d.select(F.col("k").alias(n), F.col("c").alias(f"c{n}")) for d, n in ((names, "k1"), (alias, "k2"), (alias, "k3")))
    j = t.join(a, t["x"] == a["k1"], "left").join(b, t["x"] == b["k2"], "left").join(c, t["y"] == c["k3"], "left")
    how = F.when(F.col("ck1").isNotNull(), "name").when(F.col("ck2").isNotNull(), "spelling").when(F.col("ck3").isNotNull(), "base")
    return j.select("row_id", F.coalesce("ck1", "ck2", "ck3").alias("resolved"), how.alias("how"))


def trailing_country(spark, sf):
    """Document rows whose voucher and country stand in one cell: the last one or two words cut off if they name a country."""
    v = table(spark, sf, "country_variant").groupBy(F.col("spelling").alias("k")).agg(F.max_by("country", "ord").alias("c"))
    t = table(spark, sf, "doc_row").select("row_id", "voucher", "country").distinct().filter(~absent("voucher") & ~absent("country")).withColumn("cell", F.concat_ws(" ", F.trim("voucher"), F.trim("country")))
    one, two = F.lower(F.substring_index("cell", " ", -1)), F.lower(F.substring_index("cell", " ", -2))
    a, b = v.select(F.col("k").alias("k1"), F.col("c").alias("c1")), v.select(F.col("k").alias("k2"), F.col("c").alias("c2"))
    j = t.withColumns({"one": one, "two": two}).join(F.broadcast(b), F.col("two") == F.col("k2"), "left").join(F.broadcast(a), F.col("one") == F.col("k1"), "left")
    cut = F.when(F.col("c2").isNotNull(), F.length("two")).when(F.col("c1").isNotNull(), F.length("one")).otherwise(F.lit(-1))
    head = F.trim(F.when(cut >= 0, F.expr("left(cell, length(cell) - case when c2 is not null then length(two) else length(one) end)")).otherwise(F.col("cell")))
    return j.select("row_id", head.alias("head"), F.coalesce("c2", "c1").alias("found"))


def locality_trim(spark, sf):
    t = table(spark, sf, "type_registry").select("record_id", "locality_raw").distinct()
    return t.select("record_id", C.locality_head(F.concat_ws(" ", F.coalesce("locality_raw", F.lit("")), F.lit("Page 12 Position 3"))).alias("locality"))


def country_cascade(spark, sf):
    """Registry localities: the place cache overrides the spelling of the whole text, of the leftmost bigram, of the leftmost word."""
    v = F.broadcast(table(spark, sf, "country_variant").groupBy(F.col("spelling").alias("k")).agg(F.max_by("country", "ord").alias("c")))
    cache = table(spark, sf, "locality_cache").filter("size(countries) = 1").select(F.col("locality_norm").alias("k"), F.get("countries", F.lit(0)).alias("c"))
    t = table(spark, sf, "type_registry").select("record_id", "locality_raw").distinct().filter(~absent("locality_raw")).withColumn("x", F.lower(F.trim("locality_raw")))
    words = F.filter(F.split(F.regexp_replace("x", "[^a-z]+", " "), " "), lambda w: w != "")
    grams = F.concat(
        F.array(F.struct(F.lit(1).alias("tier"), F.lit(0).alias("pos"), F.col("x").alias("g"))),
        F.transform(T.ngrams(words, 2), lambda g, i: F.struct(F.lit(2).alias("tier"), i.alias("pos"), g.alias("g"))),
        F.transform(words, lambda g, i: F.struct(F.lit(3).alias("tier"), i.alias("pos"), g.alias("g"))),
    )
    hits = t.select("record_id", F.explode(grams).alias("s")).select("record_id", "s.*")
    by_name = hits.join(v, hits["g"] == v["k"]).groupBy("record_id").agg(F.min_by("c", F.struct("tier", "pos")).alias("n"))
    by_place = t.join(cache, t["x"] == cache["k"]).select("record_id", F.col("c").alias("p"))
    return t.select("record_id").join(by_place, "record_id", "left").join(by_name, "record_id", "left").select("record_id", F.coalesce("p", "n").alias("country"))


def _registry(spark, sf, *columns):
    return table(spark, sf, "type_registry").select("record_id", *columns).distinct()


def typification_split(spark, sf):
    t = _registry(spark, sf, "typification").filter("typification is not null")
    x = t.select("record_id", F.posexplode(R.typification(F.col("typification"))).alias("pos", "t"))
    return x.select("record_id", "pos", F.col("t.type_of_type").alias("kind"), F.array_join("t.material", "|").alias("material"))


def merge_types(spark, sf):
    """Types of the registry and those parsed from the typification that it lacks."""
    t = table(spark, sf, "type_registry").select("record_id", "type_items", "typification").distinct().filter("typification is not null and type_items is not null")
    parsed = F.filter(R.typification(F.col("typification")), lambda x: x["type_of_type"] != "")
    m = R.merged_types(F.col("type_items"), parsed)
    return t.select("record_id", F.size(m).alias("types"), F.array_join(F.transform(m, lambda x: F.lower(x["type_of_type"])), "|").alias("kinds"))


def tax_status(spark, sf):
    t = _registry(spark, sf, "species", "name_status", "current_name")
    return t.select("record_id", R.taxonomic_status(F.col("name_status"), F.col("species"), F.col("current_name")).alias("status"))


def rank_filter(spark, sf):
    t = _registry(spark, sf, "taxon_rank", "name_status")
    return t.filter(F.col("taxon_rank").isin("sp.", "f.", "var.") & F.col("name_status").isin("Legitimate", "Orthographic variant", "Invalid")).select("record_id", "name_status")


def protologue(spark, sf):
    """Citations taken apart and built again."""
    p = F.col("protologue")
    e = lambda i: F.regexp_extract(p, r"^(.*) (\d+): (\d+) \((\d{4})\)$", i)
    part = lambda i: F.when(e(i) != "", e(i))
    return _registry(spark, sf, "protologue").filter("protologue is not null").select("record_id", R.protologue(part(1), part(2), F.lit(None).cast("string"), part(3), part(4)).alias("built"))


def inherit_base(spark, sf):
    """Host and country from the basionym's record where they are blank."""
    t = _registry(spark, sf, "basionym_record_id", "host", "country")
    return frames.inherit(t, "record_id", "basionym_record_id", ["host", "country"]).select("record_id", "host", "country", "inherited")


def new_only(spark, sf):
    """Names of the sequence records that the registry lacks."""
    s = table(spark, sf, "seq_record").filter(~absent("species")).select("species").distinct()
    return s.join(table(spark, sf, "type_registry").select("species"), "species", "left_anti")


def registry_upsert(spark, sf):
    t = _registry(spark, sf, "species", "name_status")
    new = t.filter(F.col("record_id").substr(-1, 1).isin("1", "3")).withColumn("name_status", F.lit("Revised"))
    return frames.upsert(t.filter(~F.col("record_id").endswith("3")), new, "record_id")


def type_from_registry(spark, sf):
    """Specimens whose code is the material of a type, with the first kind by record."""
    t = table(spark, sf, "type_registry").select("record_id", F.explode("type_items").alias("t")).select("record_id", "t.type_of_type", F.explode("t.material").alias("m")).filter(F.trim("m") != "").withColumn("code", C.code_key_type(F.col("m")))
    label = t.groupBy("code").agg(F.min_by("type_of_type", F.struct("record_id", "type_of_type")).alias("label"))
    s = table(spark, sf, "seq_record").filter(~absent("specimen_voucher")).select("seq_no", C.code_key_type(F.col("specimen_voucher")).alias("code")).distinct()
    return label.join(s.groupBy("code").agg(F.count("*").alias("records")), "code", "left").select("code", "label", F.coalesce("records", F.lit(0)).alias("records"))


def recovery_rollup(spark, sf):
    """Rows of documents with a species, by article and in all."""
    t = table(spark, sf, "doc_row").select("row_id", "source_doi", "species").distinct()
    r = t.rollup("source_doi").agg(F.count("*").alias("total"), F.count_if(~absent("species")).alias("found"))
    return r.withColumn("percent", F.round(100.0 * F.col("found") / F.col("total"), 1))


def _pairs(spark, sf):
    first = table(spark, sf, "doc_row").select(F.col("source_doi").alias("doc"), C.code_key_prose(F.col("voucher")).alias("code"), "country").filter(~absent("country") & F.col("code").isNotNull()).distinct()
    second = _rows(spark, sf, "source_doi", "voucher", "country").filter(~absent("voucher") & ~absent("country")).select(F.col("source_doi").alias("doc"), C.code_key_prose(F.col("voucher")).alias("code"), "country").distinct()
    return first, second


def pairs_confidence(spark, sf):
    return prose.merge_pairs(*_pairs(spark, sf), ["doc", "code"], "country")


def confidence_summary(spark, sf):
    p = pairs_confidence(spark, sf)
    a = p.agg(F.count("*").alias("pairs"), F.count_distinct("code").alias("codes"), F.count_distinct("doc").alias("docs"))
    long = a.unpivot([], ["pairs", "codes", "docs"], "metric", "value")
    return long.union(p.groupBy("confidence").count().select(F.concat(F.lit("confidence_"), "confidence"), "count"))


def gold_summary(spark, sf):
    """Pairs judged against the values on which an article's table rows agree."""
    first, second = _pairs(spark, sf)
    gold = frames.unanimous(second, ["doc", "code"], "country").filter("status = 'applied'").select("doc", "code", F.col("value").alias("country"))
    return prose.judged(first, gold, ["doc", "code"], "country").groupBy("status").agg(F.count("*").alias("n"))


def chunks_contained(spark, sf):
    """Occurrence test: codes of supplement rows whose letters and digits all occur in a document row's voucher.

    A contained digit run is a part of some digit run of the text, so a code meets every text through the one
    of its runs that the fewest texts hold, whatever number stands last; distinct texts meet, not rows.
    """
    runs = lambda c: F.array_distinct(F.regexp_extract_all(c, F.lit("[0-9]+"), 0))
    s = table(spark, sf, "supp_record").select(F.col("row_id").alias("supp"), F.col("voucher").alias("v")).filter("v is not null").distinct()
    d = table(spark, sf, "doc_row").select(F.col("row_id").alias("doc"), F.col("voucher").alias("w")).filter("w is not null").distinct()
    code = s.select("v").distinct().select("v", F.explode(runs("v")).alias("num"))
    text = d.select("w").distinct().select("w", F.explode(F.array_distinct(F.flatten(F.transform(runs("w"), _parts)))).alias("num"))
    text = text.join(code.select("num").distinct(), "num", "left_semi")
    often = text.groupBy("num").agg(F.count("*").alias("n"))
    rarest = code.join(often, "num", "left").groupBy("v").agg(F.min_by("num", F.struct(F.coalesce("n", F.lit(0)), "num")).alias("num"))
    pairs = rarest.join(text, "num").filter(C.chunks_contained(F.col("v"), F.col("w"))).select("v", "w")
    return s.join(pairs, "v").join(d, "w").select("supp", "doc")


def _parts(run):
    """All substrings of a text."""
    return F.flatten(F.transform(F.sequence(F.lit(1), F.length(run)), lambda i: F.transform(F.sequence(F.lit(1), F.length(run) - i + 1), lambda n: F.substring(run, i, n))))


def doi_cascade(spark, sf):
    """The article of each record: by exact title, by the accession lists, by table rows; the first hit with its method."""
    a = table(spark, sf, "article")
    title = a.filter("title is not null").groupBy(F.lower(F.trim("title")).alias("t")).agg(F.min("doi").alias("d"))
    s = table(spark, sf, "seq_record").filter("gbn is not null").select("seq_no", _acc("gbn").alias("acc"), "title").distinct()
    by_title = s.select("seq_no", F.explode(C.title_parts(F.col("title"))).alias("x")).select("seq_no", F.lower("x").alias("t")).join(title, "t").groupBy("seq_no").agg(F.min("d").alias("d"))
    lists = _listed(spark, sf).groupBy(F.col("accession").alias("acc")).agg(F.min("doi").alias("d"))
    rows = table(spark, sf, "gb_table_row").filter("source_doi is not null").select("source_doi", F.explode(_cells()).alias("acc")).groupBy("acc").agg(F.min("source_doi").alias("d"))
    by_list, by_row = (s.select("seq_no", "acc").join(x, "acc").groupBy("seq_no").agg(F.min("d").alias("d")) for x in (lists, rows))
    return frames.priority_fallback(s.select("seq_no").distinct(), "seq_no", [("title", by_title, "d"), ("list", by_list, "d"), ("table", by_row, "d")])


def supplement_lookup(spark, sf):
    """Codes of supplement rows by marker, the first row that gives each."""
    t = table(spark, sf, "supp_record").select("row_id", F.explode("gb_codes").alias("marker", "code")).distinct()
    return t.filter(~absent("code")).groupBy(F.lower("marker").alias("marker"), F.upper(F.trim("code")).alias("code")).agg(F.min("row_id").alias("first"), F.count("*").alias("rows"))


def hits_by_genus(spark, sf):
    """Records grouped by genus; the three longest sequences of the first record's species."""
    t = table(spark, sf, "seq_record").filter(~absent("species")).select("seq_no", "gbn", "species", "bp").distinct().withColumn("genus", C.genus_of(F.col("species"))).filter("genus is not null")
    first = t.groupBy("genus").agg(F.min_by("species", "seq_no").alias("species"), F.count("*").alias("records"))
    top = frames.top_per_group(t.drop("genus"), ["species"], [F.desc("bp"), F.col("seq_no")], 3).groupBy("species").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "gbn"))), lambda x: x["gbn"]), "|").alias("hits"))
    return first.join(top, "species").select("genus", "records", "species", "hits")


def store_merge(spark, sf):
    """Article records with the vouchers of their table rows appended to the list, old ones first."""
    g = _rows(spark, sf, "source_doi", "voucher").filter(~absent("voucher")).groupBy(F.col("source_doi").alias("doi")).agg(F.array_sort(F.collect_set("voucher")).alias("more"))
    none = F.array().cast("array<string>")
    a = table(spark, sf, "article").select("doi", F.coalesce("vouchers_found", none).alias("own")).join(g, "doi", "left")
    both = F.array_union("own", F.coalesce("more", none))
    return a.select("doi", F.size(both).alias("n"), F.size(F.array_except(F.coalesce("more", none), F.col("own"))).alias("added"))


def batch_ids(spark, sf):
    """Accession numbers in batches of 200 by record number."""
    s = table(spark, sf, "seq_record").select("seq_no", "gbn").distinct()
    return frames.chunks(s, "seq_no", "gbn", 200)


QUERIES = {f.__name__: f for f in (article_rollup, article_lookup, article_of_accession, article_stats, doi_names, species_union, title_parse, title_jaccard, forward_fill, unanimous_fill, first_non_missing_merge, long_table_fields, transpose_tables, expand_merged, resolve_alias_chain, trailing_country, locality_trim, country_cascade, typification_split, merge_types, tax_status, rank_filter, protologue, inherit_base, new_only, registry_upsert, type_from_registry, recovery_rollup, pairs_confidence, confidence_summary, gold_summary, chunks_contained, doi_cascade, supplement_lookup, hits_by_genus, store_merge, batch_ids)}

_SET = lambda c, n: f"coalesce(string_agg(distinct {c}, ' | ' order by {c}) filter (where not {sql_absent(c)}), '') as {n}"
_N4 = lambda c: f"upper(regexp_replace({c}, '[\\s:/\\-.,;()\\[\\]{{}}]', '', 'g'))"
_N5 = lambda c: f"upper(regexp_replace({c}, '[ \\-/.:]', '', 'g'))"
_ALIAS = "(select spelling as k, arg_max(country, ord) as c from country_variant group by 1)"
_PAIRS = f"""a as (select distinct source_doi as doc, {_N4('voucher')} as code, country from doc_row where voucher is not null and not {sql_absent('country')}),
  b as (select distinct source_doi as doc, {_N4('voucher')} as code, country from gb_table_row where not {sql_absent('voucher')} and not {sql_absent('country')})"""
_CONF = f"""with {_PAIRS}, s as (select doc, code, max(country) as v from b group by all),
  p as (select a.doc, a.code, a.country, case when s.v is null then 'single' when s.v = a.country then 'confirmed' else 'conflict' end as confidence, 'first' as origin from a left join s using (doc, code)
        union all select doc, code, country, 'single', 'second' from b where not exists (from a where a.doc = b.doc and a.code = b.code))"""
_KINDS = "(holotype|isotype|paratype|neotype|lectotype|epitype|isolectotype|syntype)"
_TYP = f"""(select record_id, t, list_transform(regexp_extract_all(t, '(?i)\\b{_KINDS}s?\\b', 1), lambda x: upper(x[1]) || lower(x[2:])) as names, regexp_split_to_array(t, '(?i)\\b{_KINDS}s?\\b') as parts
  from (select distinct record_id, trim(regexp_replace(regexp_replace(typification, '^Typification:\\s*', ''), '(?i)\\(designated by[^)]*\\)?', '', 'g')) as t from type_registry where typification is not null))"""
_MAT = "array_to_string(list_filter(list_transform(string_split({}, ','), lambda x: trim(x)), lambda x: x <> ''), '|')"

_CELLS = f"""(select distinct row_id, source_doi, species, voucher, country, accession from (select row_id, source_doi, species, voucher, country, upper(regexp_replace(regexp_replace(unnest([{', '.join(_GB)}]), '\\s+', '', 'g'), '\\.\\d+$', '')) as accession from gb_table_row) where regexp_matches(accession, '[0-9]'))"""
# elements hold accessions between delimiters, blanks, quotes or the word "and"
_LISTED = f"""(select doi, {_VERSIONLESS('x')} as accession from (select doi, unnest(regexp_split_to_array(e, '[\\s|;,/&"]+')) as x from (select doi, unnest(gb_accessions) as e from article where doi is not null)) where x not in ('', 'and'))"""

SQL = {
    "article_rollup": f"""with t as (select distinct row_id, source_doi, species, voucher, country, {', '.join(_GB)} from gb_table_row)
      select t.source_doi, {_SET('species', 'species')}, {_SET('voucher', 'vouchers')}, {_SET('country', 'countries')}, coalesce(any_value(n), 0) as accessions, count(*) as rows from t left join (select source_doi as d, count(distinct accession) as n from {_CELLS} group by 1) on d is not distinct from source_doi group by 1""",
    "article_lookup": f"select accession, m.* from (select accession, arg_min({{'source_doi': source_doi, 'species': species, 'voucher': voucher, 'country': country}}, (source_doi, row_id)) as m from {_CELLS} where source_doi is not null group by 1)",
    "article_of_accession": f"select accession, min(doi) as doi from {_LISTED} join (select distinct {_VERSIONLESS('gbn')} as accession from seq_record where gbn is not null) using (accession) group by 1",
    "article_stats": "select count(*) as articles, count_if(has_gb_table) as with_table, count_if(has_supplementary) as with_supplement, count_if(pdf_downloaded) as downloaded, sum(coalesce(len(gb_accessions), 0))::bigint as total_codes from article",
    "doi_names": "select doi, md5(doi) as doi_hash, regexp_replace(doi, '[^A-Za-z0-9._-]+', '_', 'g') || '.pdf' as pdf, case when starts_with(doi, '10.99872') then 'mycox' when starts_with(doi, '10.99871') then 'verandian' when starts_with(doi, '10.99873') then 'polypore' when starts_with(doi, '10.99874') then 'sheets' end as publisher from article",
    "species_union": f"select doi, coalesce(string_agg(s, '|' order by s), '') as species, count(s)::int as n from (select distinct doi, s from (select doi, unnest(species_mentioned) as s from article union all select doi, species from article join gb_table_row on doi = source_doi where not {sql_absent('species')} union all select doi, null from article)) group by 1",
    "title_parse": "select seq_no, (row_number() over (partition by seq_no order by o) - 1)::int as pos, title from (select seq_no, trim(unnest(string_split(title, '|'))) as title, generate_subscripts(string_split(title, '|'), 1) as o from (select distinct seq_no, title from seq_record where title is not null)) where title <> '' and lower(title) <> 'direct submission'",
    "title_jaccard": """with a as (select doi, journal, pub_year, list_distinct(regexp_split_to_array(lower(regexp_replace(title, '[^A-Za-z]+', ' ', 'g')), ' +')) as w from article where title is not null)
      select * from (select a.doi as doi_a, b.doi as doi_b, len(list_intersect(a.w, b.w))::int as common, len(list_distinct(list_concat(a.w, b.w)))::int as "all" from a join a b on a.journal = b.journal and a.pub_year = b.pub_year and a.doi < b.doi) where common * 10 >= "all" * 6""",
    "forward_fill": f"select row_id, last_value(case when not {sql_absent('species')} then species end ignore nulls) over (partition by source_doi, source_table_index order by row_id rows between unbounded preceding and current row) as filled, {sql_absent('species')} as was_blank from (select distinct row_id, source_doi, source_table_index, species from gb_table_row)",
    "unanimous_fill": f"select source_doi, code, case when n = 1 then 'applied' else 'ambiguous' end as status, case when n = 1 then choices end as value, choices from (select source_doi, {_N4('voucher')} as code, count(distinct country) as n, string_agg(distinct country, '|' order by country) as choices from gb_table_row where not {sql_absent('voucher')} and not {_MISS('country')} group by 1, 2)",
    "first_non_missing_merge": f"select key, {', '.join(f'arg_min({c}, row_id) filter (where not {_MISS(c)}) as {c}' for c in ('species', 'voucher', 'country', 'gb_lsu'))}, count(*) as merged from (select distinct row_id, concat_ws('#', source_doi, {_VERSIONLESS('gb_its')}) as key, species, voucher, country, gb_lsu from gb_table_row where gb_its is not null) group by 1",
    "long_table_fields": f"""select header, coalesce(map {{{', '.join(f"'{a}': '{b}'" for a, b in _ALIASES)}}}[lower(header)], 'other') as field, count(*) as cells, count(distinct value) as values from (select distinct row_id, e.key as header, e.value as value from (select row_id, unnest(map_entries(raw_row)) as e from gb_table_row)) where not {sql_absent('value')} group by 1, 2""",
    "transpose_tables": "select distinct e.key as r, row_id::varchar as c, e.value as value from (select row_id, unnest(map_entries(raw_row)) as e from gb_table_row)",
    "expand_merged": "select row_id, (o - 1)::int as pos, code from (select row_id, trim(regexp_replace(unnest(l), '\\)$', '')) as code, generate_subscripts(l, 1) as o from (select distinct row_id, regexp_split_to_array(voucher, '\\s*[,=:]\\s*|\\s*\\(') as l from gb_table_row where voucher is not null)) where code <> ''",
    "resolve_alias_chain": f"select row_id, coalesce(n.c, a.c, b.c) as resolved, case when n.c is not null then 'name' when a.c is not null then 'spelling' when b.c is not null then 'base' end as how from (select distinct row_id, lower(trim(country)) as x, trim(regexp_replace(lower(trim(country)), '\\(.*$', '')) as y from gb_table_row where not {sql_absent('country')}) t left join (select distinct lower(country) as k, country as c from country_variant) n on n.k = x left join {_ALIAS} a on a.k = x left join {_ALIAS} b on b.k = y",
    "trailing_country": f"""select row_id, trim(case when c2 is not null then left(cell, length(cell) - length(two)) when c1 is not null then left(cell, length(cell) - length(one)) else cell end) as head, coalesce(c2, c1) as found
      from (select t.*, b.c as c2, a.c as c1 from (select row_id, cell, lower(w[-1]) as one, lower(case when len(w) > 1 then w[-2] || ' ' || w[-1] else w[-1] end) as two from (select distinct row_id, concat_ws(' ', trim(voucher), trim(country)) as cell, string_split(concat_ws(' ', trim(voucher), trim(country)), ' ') as w from doc_row where not {sql_absent('voucher')} and not {sql_absent('country')})) t
      left join {_ALIAS} b on b.k = two left join {_ALIAS} a on a.k = one)""",
    "locality_trim": "select distinct record_id, trim(regexp_split_to_array(concat_ws(' ', coalesce(locality_raw, ''), 'Page 12 Position 3'), '(?i)(Page|Position|Citations|Published)')[1]) as locality from type_registry",
    "country_cascade": f"""with t as (select distinct record_id, lower(trim(locality_raw)) as x from type_registry where not {sql_absent('locality_raw')}), w as (select record_id, list_filter(string_split(regexp_replace(x, '[^a-z]+', ' ', 'g'), ' '), lambda y: y <> '') as w from t),
      h as (select record_id, 1 as tier, 0::bigint as pos, x as g from t union all select record_id, 3, i, w[i + 1] from (select record_id, w, unnest(range(0, len(w))) as i from w) union all select record_id, 2, i, w[i + 1] || ' ' || w[i + 2] from (select record_id, w, unnest(range(0, len(w) - 1)) as i from w))
      select record_id, coalesce(p.c, n.c) as country from t left join (select locality_norm as k, countries[1] as c from locality_cache where len(countries) = 1) p on p.k = x left join (select record_id, arg_min(c, (tier, pos)) as c from h join {_ALIAS} v on v.k = g group by 1) n using (record_id)""",
    "typification_split": f"select record_id, (i - 1)::int as pos, names[i] as kind, {_MAT.format('parts[i + 1]')} as material from (select *, unnest(range(1, len(names) + 1)) as i from {_TYP}) union all select record_id, 0, '', {_MAT.format('t')} from {_TYP} where len(names) = 0 and t <> ''",
    "merge_types": f"""select record_id, len(k)::int as types, array_to_string(k, '|') as kinds from (select record_id, list_concat(h, list_filter(list_transform(names, lambda x: lower(x)), lambda x: not list_contains(h, x))) as k from (
      select y.record_id, names, list_transform(type_items, lambda x: lower(x.type_of_type)) as h from {_TYP} y join (select distinct record_id, type_items from type_registry where type_items is not null) r using (record_id)))""",
    "tax_status": "select distinct record_id, case when lower(trim(name_status)) = 'invalid' then 'invalid' when lower(trim(name_status)) = 'orthographic variant' then 'orthographic_variant' when coalesce(trim(current_name), '') = '' then 'unresolved' when trim(species) = trim(current_name) then 'accepted' else 'synonym' end as status from type_registry",
    "rank_filter": "select distinct record_id, name_status from type_registry where taxon_rank in ('sp.', 'f.', 'var.') and name_status in ('Legitimate', 'Orthographic variant', 'Invalid')",
    "protologue": "select distinct record_id, case when regexp_matches(protologue, '^(.*) (\\d+): (\\d+) \\((\\d{4})\\)$') then protologue else '' end as built from type_registry where protologue is not null",
    "inherit_base": f"""with t as (select distinct record_id, basionym_record_id, host, country from type_registry) select t.record_id, {', '.join(f"coalesce(case when not {_MISS('t.' + c)} then t.{c} end, b.{c}) as {c}" for c in ('host', 'country'))}, b.record_id is not null as inherited from t left join t b on b.record_id = t.basionym_record_id""",
    "new_only": f"select distinct species from seq_record where not {sql_absent('species')} and species not in (select species from type_registry where species is not null)",
    "registry_upsert": "select distinct record_id, species, case when right(record_id, 1) in ('1', '3') then 'Revised' else name_status end as name_status from type_registry",
    "type_from_registry": f"""with t as (select {_N5('m')} as code, arg_min(kind, (record_id, kind)) as label from (select record_id, i.type_of_type as kind, unnest(i.material) as m from (select record_id, unnest(type_items) as i from type_registry)) where trim(m) <> '' group by 1)
      select t.code, label, coalesce(n, 0) as records from t left join (select code, count(*) as n from (select distinct seq_no, {_N5('specimen_voucher')} as code from seq_record where not {sql_absent('specimen_voucher')}) group by 1) s using (code)""",
    "recovery_rollup": f"select source_doi, total, found, round(100.0 * found / total, 1) as percent from (select source_doi, count(*) as total, count_if(not {sql_absent('species')}) as found from (select distinct row_id, source_doi, species from doc_row) group by rollup (source_doi))",
    "pairs_confidence": f"{_CONF} select * from p",
    "confidence_summary": f"{_CONF} select 'pairs' as metric, count(*) as value from p union all select 'codes', count(distinct code) from p union all select 'docs', count(distinct doc) from p union all select 'confidence_' || confidence, count(*) from p group by 1",
    "gold_summary": f"with {_PAIRS}, g as (select doc, code, min(country) as g from b group by all having count(distinct country) = 1) select case when g is null then 'not_in_gold' when g = country then 'match' else 'mismatch' end as status, count(*) as n from a left join g using (doc, code) group by 1",
    "chunks_contained": """with s as (select distinct voucher as v, list_concat(regexp_extract_all(lower(voucher), '[a-z]+'), regexp_extract_all(voucher, '[0-9]+')) as runs from supp_record where regexp_matches(voucher, '[A-Za-z]') and regexp_matches(voucher, '[0-9]')), d as (select distinct voucher as w, lower(voucher) as low from doc_row where voucher is not null),
      p as (select v, w from s join d on contains(low, runs[-1]) where len(list_filter(runs, lambda x: not contains(low, x))) = 0)
      select supp, doc from p join (select distinct row_id as supp, voucher as v from supp_record) using (v) join (select distinct row_id as doc, voucher as w from doc_row) using (w)""",
    "doi_cascade": f"""with s as (select distinct seq_no, {_VERSIONLESS('gbn')} as acc, title from seq_record where gbn is not null),
      t as (select seq_no, min(d) as d from (select seq_no, lower(trim(unnest(string_split(title, '|')))) as x from s) join (select lower(trim(title)) as x, min(doi) as d from article group by 1) using (x) where x <> '' and x <> 'direct submission' group by 1),
      l as (select seq_no, min(d) as d from s join (select accession as acc, min(doi) as d from {_LISTED} group by 1) using (acc) group by 1),
      r as (select seq_no, min(d) as d from s join (select accession as acc, min(source_doi) as d from {_CELLS} where source_doi is not null group by 1) using (acc) group by 1)
      select seq_no, coalesce(t.d, l.d, r.d) as value, case when t.d is not null then 'title' when l.d is not null then 'list' else 'table' end as method from (select distinct seq_no from s) left join t using (seq_no) left join l using (seq_no) left join r using (seq_no) where coalesce(t.d, l.d, r.d) is not null""",
    "supplement_lookup": f"select lower(e.key) as marker, upper(trim(e.value)) as code, min(row_id) as first, count(*) as rows from (select distinct row_id, e from (select row_id, unnest(map_entries(gb_codes)) as e from supp_record)) where not {sql_absent('e.value')} group by 1, 2",
    "hits_by_genus": f"""with t as (select * from (select distinct seq_no, gbn, species, bp, split_part(trim(species), ' ', 1) as genus from seq_record where not {sql_absent('species')}) where length(genus) >= 3 and not ends_with(genus, '.')),
      p as (select species, string_agg(gbn, '|' order by r) as hits from (select *, row_number() over (partition by species order by bp desc, seq_no) as r from t) where r <= 3 group by 1)
      select genus, records, species, hits from (select genus, arg_min(species, seq_no) as species, count(*) as records from t group by 1) join p using (species)""",
    "store_merge": f"""select a.doi, (len(list_distinct(list_concat(o, coalesce(m, [])))) + (case when len(list_filter(o, lambda x: x is null)) > 0 then 1 else 0 end))::int as n, len(list_filter(coalesce(m, []), lambda x: not list_contains(o, x)))::int as added
      from (select doi, coalesce(vouchers_found, []) as o from article) a left join (select source_doi as doi, list(distinct voucher) as m from gb_table_row where not {sql_absent('voucher')} group by 1) using (doi)""",
    "batch_ids": "select chunk, count(*) as n, arg_min(gbn, seq_no) as first, arg_max(gbn, seq_no) as last from (select seq_no, gbn, ((row_number() over (order by seq_no) - 1) // 200)::bigint as chunk from (select distinct seq_no, gbn from seq_record)) group by 1",
}
