"""Countries of cells, localities and specimens, by joins of distinct values with the country list.

The list ``(country, spelling, ord)`` is a fixed dimension; ``ord`` may be left out. Spellings of two or three letters are codes
and only count in upper case; of equal spellings the last by ``ord`` counts. All functions map the distinct
values of a column, so that a value of a third of all rows is resolved once; callers join the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tokens as K
from ..functions.codes import code_key_match, locality_head
from ..functions.missing import absent
from ..functions.text import ascii_fold, ngrams


def _keys(variants: DataFrame) -> DataFrame:
    """``(kind, key, country)``: names and spellings in lower case, codes in upper case; each key once."""
    if "ord" not in variants.columns:
        variants = variants.withColumn("ord", F.lit(0))
    short = F.col("spelling").rlike("^[A-Za-z]{2,3}$")
    names = variants.select(F.lit("name").alias("kind"), F.lower("country").alias("key"), "country", F.lit(0).alias("ord"))
    words = variants.filter(~short).select(F.lit("alias").alias("kind"), F.lower("spelling").alias("key"), "country", "ord")
    codes = variants.filter(short).select(F.lit("code").alias("kind"), F.upper("spelling").alias("key"), "country", "ord")
    return names.union(words).union(codes).dropna(subset=["key", "country"]).groupBy("kind", "key").agg(F.max_by("country", F.struct("ord", "country")).alias("country"))


def _tries(*steps: tuple[str, str, Column]) -> Column:
    return F.filter(F.array(*[F.struct(F.lit(i).alias("step"), F.lit(how).alias("how"), F.lit(kind).alias("kind"), key.alias("key")) for i, (how, kind, key) in enumerate(steps)]), lambda x: x["key"].isNotNull())


def _first_hit(values: DataFrame, tries: Column, variants: DataFrame) -> DataFrame:
    hit = values.select("value", F.explode(tries).alias("t")).select("value", "t.*").join(_keys(variants), ["kind", "key"])
    return hit.groupBy("value").agg(F.min_by(F.struct("country", "how"), "step").alias("m")).select("value", "m.*")


def _values(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).alias("value")).filter("value is not null").distinct()


def resolve(df: DataFrame, column: str, variants: DataFrame) -> DataFrame:
    """``(value, country, how)`` of the values that are a country: by name, alias, alias without accents, code, or the part before a bracket."""
    x = F.trim("value")
    low, plain = F.lower(x), ascii_fold(x)
    base = F.trim(F.regexp_extract(x, r"^([A-Za-z .]+?)\s*\(", 1))
    base = F.when(base != "", base)
    tries = _tries(
        ("name", "name", low), ("alias", "alias", low), ("folded", "alias", F.when(plain != low, plain)), ("code", "code", F.when(x.rlike("^[A-Z]{2,3}$"), x)),
        ("base", "name", F.lower(base)), ("base", "alias", F.lower(base)), ("base", "code", F.when(base.rlike("^[A-Z]{2,3}$"), base)),
    )
    return _first_hit(_values(df, column), tries, variants)


def canonical_name(df: DataFrame, column: str, variants: DataFrame) -> DataFrame:
    """``(value, country, how)`` by name, alias or code in any case; once more with semicolons and slashes as blanks."""
    x = F.trim("value")
    again = F.trim(F.regexp_replace(F.regexp_replace(x, "[;/]", " "), r"\s+", " "))
    steps = [(how, kind, F.upper(v) if kind == "code" else F.lower(v)) for how, v in (("plain", x), ("cleaned", again)) for kind in ("name", "alias", "code")]
    return _first_hit(_values(df, column), _tries(*steps), variants)


def detect(df: DataFrame, column: str, variants: DataFrame, cache: DataFrame, geocoded: DataFrame | None = None) -> DataFrame:
    """``(value, country, choices, how)`` of localities: what a text names, overridden by the place cache, else by a geocoder's table.

    The text before "Page", "Position", "Citations" or "Published" counts: as a whole, as folded whole, then its
    leftmost pair of words, then its leftmost word that names a country. ``cache`` (locality_norm, countries)
    and ``geocoded`` (place, countries) may give several countries: then country is null and choices lists them.
    """
    values = _values(df, column).withColumn("head", locality_head(F.col("value"))).filter("head <> ''")
    norm = F.trim(F.regexp_replace(ascii_fold(F.col("head")), ",", " "))
    words = F.filter(F.split(norm, r"\s+"), lambda w: w != "")
    gram = lambda tier, n: F.transform(ngrams(words, n), lambda g, i: F.struct(F.lit(tier).alias("tier"), i.alias("pos"), g.alias("key")))
    whole = F.array(F.struct(F.lit(0).alias("tier"), F.lit(0).alias("pos"), F.lower("head").alias("key")), F.struct(F.lit(1).alias("tier"), F.lit(0).alias("pos"), norm.alias("key")))
    each = values.select("value", F.explode(F.concat(whole, gram(2, 2), gram(3, 1))).alias("t")).select("value", "t.*")
    named = each.join(_keys(variants).filter("kind <> 'code'").select("key", "country"), "key").groupBy("value").agg(F.min_by("country", F.struct("tier", "pos", "country")).alias("named"))
    list_of = lambda t, key, name: t.select(F.col(key).alias("norm"), F.array_sort(F.array_distinct("countries")).alias(name)).filter(f"size({name}) > 0").dropDuplicates(["norm"])
    got = values.withColumn("norm", F.trim(ascii_fold(F.col("head")))).join(list_of(cache, "locality_norm", "cached"), "norm", "left").join(named, "value", "left")
    got = got.join(list_of(geocoded, "place", "coded"), "norm", "left") if geocoded is not None else got.withColumn("coded", F.lit(None).cast("array<string>"))
    many = F.coalesce("cached", F.when(F.col("named").isNotNull(), F.array("named")), "coded")
    how = F.when(F.col("cached").isNotNull(), "cache").when(F.col("named").isNotNull(), "text").otherwise("geocoder")
    return got.withColumn("choices", many).filter("choices is not null").select("value", F.when(F.size("choices") == 1, F.get("choices", F.lit(0))).alias("country"), "choices", how.alias("how"))


def resolve_extended(df: DataFrame, column: str, variants: DataFrame, cache: DataFrame) -> DataFrame:
    """``resolve``, then ``detect`` for what looks like no accession, voucher, species or code and lies in one country."""
    values = _values(df, column)
    sure = resolve(df, column, variants)
    x = F.trim("value")
    code = x.rlike(r"[A-Z]{2,}\s*\d") & ~x.rlike("(?i)rep[.]|republic")
    guarded = (F.length(x) < 2) | K.is_accession(x) | K.matches(x, K.VOUCHERS) | K.is_species(x) | x.rlike(r"^\d+$") | code
    rest = values.join(sure.select("value"), "value", "left_anti").filter(~guarded)
    found = detect(rest, "value", variants, cache).filter("country is not null").select("value", "country", F.lit("detected").alias("how"))
    return sure.unionByName(found)


def registry_country(rows: DataFrame, key: str, code: str, aliases: DataFrame, sources: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """``(key, country, source, matched)``: the first country that a source knows for the row's code or an alias of its cluster.

    ``aliases`` (cluster_key, alias); candidates are the own code, the cluster's key, then its aliases in order.
    ``sources`` (name, table (code, country)) are asked in order for each candidate before the next candidate.
    Codes are compared by ``code_key_match``; of several rows of a source the least country counts.
    """
    norm = lambda c: code_key_match(F.trim(c))
    own = rows.filter(~absent(code)).select(key, F.trim(code).alias("own"), norm(F.col(code)).alias("k")).filter("k <> ''").distinct()
    members = aliases.select("cluster_key", norm(F.col("alias")).alias("k")).union(aliases.select("cluster_key", norm(F.col("cluster_key")).alias("k"))).distinct()
    lists = aliases.groupBy("cluster_key").agg(F.array_sort(F.collect_set("alias")).alias("all"))
    cluster = members.groupBy("k").agg(F.min("cluster_key").alias("cluster_key")).join(lists, "cluster_key").select("k", F.array_distinct(F.concat(F.array("cluster_key"), "all")).alias("more"))
    x = own.join(cluster, "k", "left").select(key, F.posexplode(F.array_distinct(F.concat(F.array("own"), F.coalesce("more", F.array().cast("array<string>"))))).alias("pos", "candidate"))
    known = None
    for i, (name, t) in enumerate(sources):
        s = t.filter(~absent("code") & ~absent("country")).groupBy(norm(F.col("code")).alias("k")).agg(F.min("country").alias("country")).select("k", "country", F.lit(name).alias("source"), F.lit(i).alias("place"))
        known = s if known is None else known.union(s)
    hit = x.withColumn("k", norm(F.col("candidate"))).join(known, "k")
    return hit.groupBy(key).agg(F.min_by(F.struct("country", "source", F.col("candidate").alias("matched")), F.struct("pos", "place")).alias("m")).select(key, "m.*")


def mentions(df: DataFrame, keys: Sequence[str], text: str, variants: DataFrame) -> DataFrame:
    """``(keys, country)``, each once: countries that a text names in one to four words, accents and punctuation aside, or by an upper-case code."""
    letters = lambda c: F.trim(F.regexp_replace(ascii_fold(c), "[^a-z]+", " "))
    words = F.filter(F.split(letters(F.col(text)), " "), lambda w: w != "")
    # each word with the three after it; names meet their first word
    w = df.select(*keys, words.alias("w"))
    heads = F.transform("w", lambda x, i: F.struct(x.alias("first"), F.concat(F.array_join(F.slice("w", i + 1, F.lit(4)), " "), F.lit(" ")).alias("run")))
    runs = w.select(*keys, F.explode(heads).alias("h")).select(*keys, "h.*")
    codes = df.select(*keys, F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(r"\b[A-Z]{2,3}\b"), 0))).alias("key"))
    dim = _keys(variants)
    names = dim.filter("kind <> 'code'").select(letters(F.col("key")).alias("key"), "country").filter((F.col("key") != "") & (F.size(F.split("key", " ")) <= 4)).distinct()
    names = names.select(F.substring_index("key", " ", 1).alias("first"), F.concat("key", F.lit(" ")).alias("name"), "country")
    named = runs.join(names, (runs["first"] == names["first"]) & F.startswith(runs["run"], names["name"]))
    coded = codes.join(dim.filter("kind = 'code'").select("key", "country"), "key")
    return named.select(*keys, "country").union(coded.select(*keys, "country")).distinct()
