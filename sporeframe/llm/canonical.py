"""Mapping free-entered place values to a canonical list of countries, with column expressions only.

Distinct values are worked on, whatever their number of rows. A value is repaired (double-encoded
text, spaced letters, accents, case), cut into segments at punctuation, and its word n-grams are looked
up in the reference. What stays unresolved goes through a pigeonhole join: every reference string of
length L is cut into k+1 segments; a string within k edits holds one of them unchanged, at a position
shifted by k at most, so an equality join on (length, segment number, substring) finds every candidate
and ``levenshtein`` verifies it. Values without any country, by an anti-join, come out as ``unmatched``.

The reference is a parameter: spellings and single-country places from tables, and localised and foreign
country names that the JVM's locale data give for the countries (``locale_names``).
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.missing import absent
from ..session import Stages

UNMATCHED = "unmatched"
EDITS = 2

#: Languages whose country names count as spellings.
LANGUAGES = ("en", "de", "fr", "es", "pt", "it", "nl", "sv", "da", "nb", "fi", "pl", "cs", "sk", "hu", "ro", "tr", "hr", "sl", "lt", "et", "id", "vi", "ca", "gl", "af", "is", "ru", "uk", "el", "ja", "zh", "zh-TW", "ko")
#: Languages for the names of countries outside the list.
OUTSIDE_LANGUAGES = ("en", "de", "fr", "es", "pt", "it")

#: Former and informal names that no locale gives, by ISO code.
FORMER = {
    "northern rhodesia": "ZM", "british guiana": "GY", "belgian congo": "CD", "french congo": "CG", "middle congo": "CG", "congo brazzaville": "CG",
    "congo kinshasa": "CD", "congo dem rep": "CD", "congo democratic republic": "CD", "congo rep": "CG", "congo republic": "CG", "rep congo": "CG", "d r congo": "CD", "drc": "CD",
    "persia": "IR", "abyssinia": "ET", "nyasaland": "MW", "french sudan": "ML", "french soudan": "ML", "dutch east indies": "ID", "netherlands east indies": "ID",
    "spanish guinea": "GQ", "french guinea": "GN", "guinea conakry": "GN", "guinee conakry": "GN", "korea rep": "KR", "rok": "KR", "s korea": "KR", "prc": "CN", "pr china": "CN", "mainland china": "CN",
    "papua n guinea": "PG", "territory of new guinea": "PG", "england": "GB", "scotland": "GB", "wales": "GB", "northern ireland": "GB", "britain": "GB", "u k": "GB",
    "us of america": "US", "united states america": "US", "united states of north america": "US", "america": "US", "the states": "US", "eire": "IE", "irish republic": "IE", "republic of ireland": "IE",
    "hellas": "GR", "helvetia": "CH", "lusitania": "PT", "new granada": "CO", "upper peru": "BO", "banda oriental": "UY", "hispania": "ES", "italia": "IT", "gallia": "FR", "germania": "DE", "sinae": "CN",
    "bohemia": "CZ", "moravia": "CZ", "annam": "VN", "tonkin": "VN", "cochinchina": "VN", "malaya": "MY", "sarawak": "MY", "gold coast": "GH", "ceylon": "LK", "burma": "MM", "rhodesia": "ZW", "southern rhodesia": "ZW",
    "upper volta": "BF", "dahomey": "BJ", "swaziland": "SZ", "bechuanaland": "BW", "basutoland": "LS", "south west africa": "NA", "tanganyika": "TZ", "british honduras": "BZ", "dutch guiana": "SR", "north korea": "KP", "korea dem rep": "KP", "portuguese guinea": "GW", "gambia": "GM", "ivory coast": "CI", "macedonia": "MK", "holland": "NL",
    "brd": "DE", "bundesrepublik deutschland": "DE", "federal republic of germany": "DE", "grande bretagne": "GB", "grossbritannien": "GB", "gran bretana": "GB", "gra bretanha": "GB", "gran bretagna": "GB",
    "rep dominicana": "DO", "republica portuguesa": "PT", "philippine islands": "PH", "the philippine islands": "PH", "islas filipinas": "PH", "repubblica italiana": "IT", "reino de espana": "ES", "konigreich schweden": "SE",
    "dom republic": "DO", "malagasy republic": "MG", "rossija": "RU", "rossiya": "RU", "aust": "AU", "gt britain": "GB", "n zealand": "NZ", "s africa": "ZA", "eq guinea": "GQ", "fr guiana": "GF", "french guyana": "GF", "switz": "CH",
}
#: Names that hold a country's name but don't name it.
BLOCKS = ("new mexico", "new england", "new south wales", "gulf of mexico", "gulf of guinea", "indian ocean", "indian territory", "sea of japan", "south china sea", "east china sea", "guinea ecuatorial", "peru indiana", "turkey creek", "new guinea", "british columbia", "district of columbia", "inner mongolia", "south georgia", "guinea pig", "china grove", "lebanon")
#: Words that make a name before them a place of its own.
PLACE_WORDS = ("creek", "ridge", "hill", "hills", "valley", "lagoon", "forest", "reserve", "plateau", "lake", "river", "mountain", "mountains", "gorge", "canyon", "point", "bay", "run", "falls", "springs", "town", "city", "county", "street", "road", "draw", "sea", "ocean", "gulf", "grove", "island", "islands", "national")
#: Words before a country's name that qualify it.
QUALIFIERS = ("ex", "prob", "probably", "prope", "near", "from", "in", "of", "the", "cf", "n", "s", "e", "w", "ne", "nw", "se", "sw", "north", "south", "east", "west", "northern", "southern", "eastern", "western", "central", "northeast", "northwest", "southeast", "southwest", "upper", "lower", "coastal")


def _letters() -> tuple[str, str]:
    """Accented Latin letters and their base letters, by Unicode decomposition."""
    a, b = [], []
    for cp in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFKD", chr(cp))[0]
        if base != chr(cp) and base.isascii() and base.isalpha():
            a.append(chr(cp))
            b.append(base.lower())
    return "".join(a) + "øđłıħðθ", "".join(b) + "odlihdt"


_FROM, _TO = _letters()


def repaired(c: Column) -> Column:
    """Text that was UTF-8 read as a single-byte set, read again; anything else as it is."""
    return F.when(
        c.rlike("[ÃÂÄÅâ][\\u0080-\\u00bf\\u2010-\\u2122ŒœŠšŽžŸƒˆ˜]"),
        F.coalesce(
            F.when(c.rlike("^[\\u0000-\\u00ff]*$"), F.try_validate_utf8(F.encode(c, "ISO-8859-1").cast("string"))),
            F.when(c.rlike("^[\\u0000-\\u007f\\u00a0-\\u00ff€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]*$"), F.try_validate_utf8(F.encode(c, "windows-1252").cast("string"))),
            c,
        ),
    ).otherwise(c)


def plain(c: Column) -> Column:
    """Lower case without accents, quotes and dots; runs of single letters joined, ``rep`` written out; one blank between words."""
    x = F.regexp_replace(F.translate(F.lower(c), _FROM, _TO), r"\p{M}+", "")
    x = F.regexp_replace(F.replace(F.replace(x, F.lit("ß"), F.lit("ss")), F.lit("æ"), F.lit("ae")), r"['’‘`´ʼ]", "")
    x = F.trim(F.regexp_replace(x, r"(?U)[^\p{L}\p{N}]+", " "))
    x = F.regexp_replace(x, r"(?<=(?:^| )\p{L}) (?=\p{L}(?: |$))", "")
    return F.regexp_replace(x, r"\brep\b", "republic")


def locale_names(spark: SparkSession, codes: Iterable[str], languages: Sequence[str]) -> list[tuple[str, str]]:
    """(ISO code, name) for each country and language, from the JVM's locale data."""
    key = (tuple(codes), tuple(languages))
    if key not in _names:
        loc = spark._jvm.java.util.Locale
        ls = [loc.forLanguageTag(x) for x in key[1]]
        _names[key] = [(c, n) for c in key[0] for n in dict.fromkeys(loc("", c).getDisplayCountry(x) for x in ls) if n and n != c]
    return _names[key]


_names: dict[tuple, list[tuple[str, str]]] = {}


def country_reference(spark: SparkSession, variants: DataFrame, places: DataFrame) -> DataFrame:
    """The reference ``(key, kind, country)``; kinds: name, code, outside, block, place.

    ``variants`` (country, spelling) is a fixed list, of which the ISO codes are read by the driver to ask
    for locale names; ``places`` (locality_norm, countries). A country is null for outside, block and
    places that lie in several countries.
    """
    listed = {r[0].upper(): r[1] for r in variants.filter("spelling rlike '^[a-z]{2}$'").select("spelling", "country").collect()}
    listed.pop("UK", None)
    every = list(spark._jvm.java.util.Locale.getISOCountries())
    inside = [c for c in every if c in listed]
    rows = [(n, "name", listed[c], 3) for c, n in locale_names(spark, inside, LANGUAGES)]
    rows += [(n, "name", listed[c], 2) if c in listed else (n, "outside", None, 2) for n, c in FORMER.items()]
    rows += [(n, "outside", None, 4) for c, n in locale_names(spark, [c for c in every if c not in listed], OUTSIDE_LANGUAGES)]
    rows += [(n, "block", None, 2) for n in BLOCKS]
    extra = spark.createDataFrame(rows, "spelling string, kind string, country string, tier int")
    # locales write "Congo - Kinshasa", "Myanmar (Burma)"
    own = variants.select("spelling", F.when(F.col("spelling").rlike("^[a-z]{2,3}$") & ~F.lower("country").eqNullSafe(F.col("spelling")), "code").otherwise("name").alias("kind"), "country", F.lit(1).alias("tier"))
    own = own.union(variants.select("country", F.lit("name"), "country", F.lit(0)).distinct())
    at = places.select(F.col("locality_norm").alias("spelling"), F.lit("place").alias("kind"), F.when(F.size("countries") == 1, F.col("countries")[0]).alias("country"), F.lit(5).alias("tier"))
    ref = own.unionByName(extra).unionByName(at).withColumn("key", plain(F.col("spelling"))).filter("key <> ''")
    best = ref.groupBy("key", "tier", "kind").agg(F.min("country").alias("country"), F.count_distinct(F.coalesce("country", F.lit(""))).alias("n"))
    # a key that means two countries on its best tier names none
    best = best.groupBy("key").agg(F.min_by(F.struct("kind", "country", "n"), F.struct("tier", "kind")).alias("b"))
    return Stages(spark, "reference").cut(best.filter("b.n = 1").select("key", "b.kind", "b.country"))


def _segments(c: Column) -> Column:
    """The parts between punctuation as array<struct<text, first>>: first marks a part before a colon."""
    x = F.regexp_replace(c, r"_", " ")
    x = F.regexp_replace(x, r"\s+[-–—]\s+", ":")
    x = F.regexp_replace(x, r"\s*:\s*", "\u0001:")
    return F.filter(
        F.transform(F.split(x, "[,;/|()\\[\\]{}\\n\\t:]"), lambda s: F.struct(plain(s).alias("text"), s.endswith("\u0001").alias("first"))),
        lambda s: s["text"] != "",
    )


def _grams(most: int = 7) -> Column:
    """All word n-grams of column ``words`` as array<struct<gram, at, n, next>>."""
    size = F.size("words")
    one = lambda i: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(most), size - i)),
        lambda n: F.struct(
            F.array_join(F.slice("words", i + 1, n), " ").alias("gram"),
            i.alias("at"),
            n.alias("n"),
            F.coalesce(F.get("words", i + n), F.lit("")).alias("next"),
            F.coalesce(F.get("words", i - 1), F.lit("")).alias("before"),
            (F.forall(F.slice("words", 1, i), lambda w: w.isin(*QUALIFIERS)) & (i + n == size)).alias("full"),
        ),
    )
    return F.flatten(F.transform(F.sequence(F.lit(0), size - 1), one))


def pigeonhole(left: DataFrame, right: DataFrame, k: int = EDITS) -> DataFrame:
    """(text, key, d) for each ``text`` of ``left`` and ``key`` of ``right`` (both distinct) at most ``k`` edits apart.

    Exact: no candidate is lost, since keys shorter than k+1 are joined on length alone. Null texts match
    nothing.
    """
    rl, tl = F.length("key"), F.length("text")
    base, more = F.floor(rl / (k + 1)), rl % (k + 1)
    # segment i of a key: the last `more` segments are one character longer
    start = lambda i: i * base + F.greatest(F.lit(0), i - (k + 1 - more))
    width = lambda i: base + F.when(i >= k + 1 - more, 1).otherwise(0)
    segs = right.filter(rl > k).select("key", rl.alias("len"), F.explode(F.transform(F.sequence(F.lit(0), F.lit(k)), lambda i: F.struct(i.alias("i"), F.substring(F.col("key"), (start(i) + 1).cast("int"), width(i).cast("int")).alias("s")))).alias("g")).select("key", "len", "g.i", "g.s")
    lens = left.filter("text is not null").select("text", tl.alias("tl"), F.explode(F.sequence(F.greatest(tl - k, F.lit(k + 1)), F.greatest(tl + k, F.lit(k + 1)))).alias("len")).filter(F.abs(F.col("len") - F.col("tl")) <= k)
    b2, m2 = F.floor(F.col("len") / (k + 1)), F.col("len") % (k + 1)
    start2 = lambda i: i * b2 + F.greatest(F.lit(0), i - (k + 1 - m2))
    width2 = lambda i: b2 + F.when(i >= k + 1 - m2, 1).otherwise(0)
    at = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.lit(k)),
            lambda i: F.transform(
                F.sequence(F.greatest(F.lit(0), start2(i) - k), start2(i) + k),
                lambda p: F.struct(i.alias("i"), F.when(p + width2(i) <= F.col("tl"), F.substring(F.col("text"), (p + 1).cast("int"), width2(i).cast("int"))).alias("s")),
            ),
        )
    )
    probes = lens.select("text", "len", F.explode(F.array_distinct(at)).alias("g")).select("text", "len", "g.i", "g.s").filter("s is not null")
    long = probes.join(segs, ["len", "i", "s"]).select("text", "key").distinct()
    # keys too short to cut meet texts of a fitting length
    short = right.filter(rl <= k).select("key", F.explode(F.sequence(F.greatest(F.lit(0), rl - k), rl + k)).alias("len")).join(left.filter(tl <= 2 * k).select("text", tl.alias("len")), "len")
    return long.union(short.select("text", "key")).withColumn("d", F.levenshtein("text", "key")).filter(F.col("d") <= k)


def map_countries(values: DataFrame, value: str, reference: DataFrame) -> DataFrame:
    """``(value, country)`` for each distinct present value; ``unmatched`` where no country comes out.

    A whole segment that names a country beats words inside one; before a colon or dash the first such
    segment counts, else the last; a name outside the list leaves the value unmatched. Next come misspelt
    names (one edit, or two neighbouring letters swapped; two edits from ten letters on), then places that
    lie in one country, exact before misspelt. If two countries are equally near, neither is taken.
    Absent values give no row; very long ones are read whole; ties have no other meaning than stated.
    """
    stages = Stages(values.sparkSession, "canonical")
    v = stages.cut(values.select(F.col(value).alias("value")).filter(~absent("value")).distinct())
    fixed = v.select("value", repaired(F.col("value")).alias("fixed"))
    seg = fixed.select("value", F.posexplode(_segments(F.col("fixed"))).alias("pos", "s")).select("value", "pos", "s.text", "s.first")
    # whole values as one more segment: "Congo, Rep.", "c o s t a  r i c a"
    whole = fixed.select("value", F.lit(-1).alias("pos"), plain(F.replace("fixed", F.lit("_"), F.lit(" "))).alias("text"), F.lit(False).alias("first"))
    seg = stages.cut(seg.union(whole))
    parts = seg.filter("pos >= 0").withColumn("words", F.split("text", " "))
    grams = parts.select("value", "pos", "first", F.size("words").alias("of"), F.explode(_grams()).alias("g")).select("value", "pos", "first", "of", "g.*")
    grams = grams.union(seg.filter("pos < 0").select("value", "pos", "first", F.lit(1), F.col("text"), F.lit(0), F.lit(1), F.lit(""), F.lit(""), F.lit(True)))
    joined = reference.filter("kind in ('name', 'outside') and key like '% %'").select(F.replace("key", F.lit(" "), F.lit("")).alias("key"), "kind", "country").dropDuplicates(["key"])
    ref = reference.unionByName(joined.join(reference, "key", "left_anti"))
    hits = stages.cut(grams.join(ref, grams["gram"] == ref["key"]).drop("key"))

    ok = (F.col("kind") != "place") & ((F.col("kind") != "code") | (F.col("n") == F.col("of")))
    ok &= ~F.col("kind").isin("name", "outside") | F.col("full") | (~F.col("next").isin(*PLACE_WORDS) & (F.col("before") != "new"))
    # in a segment the longest name stands, then the first
    names = hits.filter(ok).groupBy("value", "pos", "first").agg(F.max_by(F.struct("kind", "country", "full"), F.struct("n", (-F.col("at")).alias("a"))).alias("h")).select("value", "pos", "first", "h.*").filter("kind <> 'block'")
    # "Georgia, USA" is the state
    us = names.filter("country = 'United States'").select("value").distinct()
    names = names.filter("not country <=> 'Georgia'").unionByName(names.filter("country = 'Georgia'").join(us, "value", "left_anti"))
    best = F.struct("full", (F.col("pos") == -1).alias("w"), F.col("first"), F.when(F.col("first"), -F.col("pos")).otherwise(F.col("pos")).alias("p"))
    named = stages.cut(names.groupBy("value").agg(F.max_by(F.struct("country", "full"), best).alias("c")).select("value", "c.country", "c.full"))

    # words inside a segment may belong to a longer, misspelt name: "Frenchh Guiana"
    rest = v.join(named.filter("full"), "value", "left_anti")
    strip = r"^(?:(?:" + "|".join(QUALIFIERS) + r") )+"
    cand = seg.join(rest, "value", "left_semi").select("value", F.explode(F.array_distinct(F.array("text", F.regexp_replace("text", strip, "")))).alias("text"))
    cand = stages.cut(cand.filter("length(text) >= 4 and text rlike '[a-z]'").distinct())
    targets = reference.filter("kind in ('name', 'outside', 'place') and length(key) >= 4")
    near = pigeonhole(cand.select("text").distinct(), targets.select("key"))
    letters = lambda c: F.array_sort(F.split(c, ""))
    swap = (F.col("d") == 2) & (letters("text") == letters("key"))
    near = near.filter((F.col("d") > 0) & ((F.col("d") == 1) | swap | (F.least(F.length("text"), F.length("key")) >= 10))).withColumn("cost", F.when(swap, 1.5).otherwise(F.col("d").cast("double")))
    # beside words that name a country only longer names count
    near = near.join(targets, "key")
    near = cand.join(near, "text").join(named.select("value", F.lit(True).alias("inner")), "value", "left").filter("inner is null or key like '% %'").select("value", F.when(F.col("kind") != "place", 0).otherwise(3).alias("rank"), "cost", "country", F.when(F.col("kind") == "outside", 1).otherwise(0).alias("out"))
    inner = named.filter("not full").select("value", F.lit(1), F.lit(0.0), "country", F.lit(0))
    exact = hits.filter("kind = 'place'").join(rest, "value", "left_semi").groupBy("value").agg(F.max_by(F.struct("country"), F.struct("n", "pos")).alias("c"), F.count_distinct(F.coalesce("country", F.lit(""))).alias("m"))
    exact = exact.select("value", F.lit(2), F.lit(0.0), F.when(F.col("m") == 1, F.col("c.country")), F.lit(0))
    top = near.union(inner).union(exact).groupBy("value", "rank", "cost", "out").agg(F.min("country").alias("country"), F.count_distinct(F.coalesce("country", F.lit(""))).alias("n"))
    found = top.groupBy("value").agg(F.min_by(F.struct("country", "n"), F.struct("rank", "cost", "out")).alias("b")).filter("b.n = 1 and b.country is not null").select("value", "b.country")
    found = stages.cut(named.filter("full and country is not null").select("value", "country").union(found))
    none = v.join(found, "value", "left_anti").select("value", F.lit(UNMATCHED).alias("country"))
    return found.union(none)
