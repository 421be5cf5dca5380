"""Predicates on single tokens and lines of article tables: what a cell is, by its form alone.

Java regular expressions over columns; where a query has an SQL oracle, without look-around. A null is
nothing: every predicate is false for it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Forms of an accession without version.
ACCESSION = r"^([A-Z]\d{5}|[A-Z]{2}\d{6,8})$"
#: Marks of a footnote behind an accession.
FOOTNOTES = "*†‡§"
#: Forms of a species name; full or abbreviated genus, qualifier, epithet or "sp.".
SPECIES = (
    r"[A-Z][a-z]{2,}\.?\s+((cf|aff)\.\s+)?[a-z]",
    r"[A-Z]\.\s*((cf|aff)\.\s+)?[a-z]{3,}",
    r"[A-Z]\.\s*sp\.?(\s|$)",
    r"[A-Z]\s+((cf|aff)\.\s+)?[a-z]{3,}",
)
#: Forms of a voucher.
VOUCHERS = (
    r"[A-Z]{2,7}[-:\s]\s*[A-Za-z]*\d+", r"[A-Z][a-z]+\.?\s+\d+", r"FP-\d+", r"[A-Z]{1,3}\s+\d+", r"[A-Z]+\s*,\s*[A-Z]", r"[A-Z]{2,}\s+[A-Z]",
    r"[A-Z]\.\s*[A-Z][. ]\s*[A-Z]", r"#\s*\d+", r"[A-Z]\d+", r"[A-Z]{3,}\d{2,}", r"[A-Z][a-z]+-[A-Z]+\d+", r"[A-Z]\.\s*&\s*[A-Z]",
    r"Mushroom\s+Observer", r"[A-Z]{2,}[a-z]{2,}\s+[A-Z]?\d+", r"[A-Z]\.\s+[A-Z][a-z]+\s+\d+", r"\d+[A-Z]{2,}", r"IO\.\d+\.\d+",
)
#: Forms of a literature reference, anywhere in the text.
REFERENCES = (
    r"(et\s+al|[A-Z][a-z]+\s+and\s+[A-Z]).*\(?(19|20)\d{2}\)?", r"[A-Z][a-z]+\s+\(?(19|20)\d{2}[a-z]?\)?", r"[A-Z][a-z]+\s+et\s+al\.?", r"al\.\s*\(?(19|20)\d{2}",
    r"GenBank\s+direct", r"direct\s+submission", r"[Tt]his\s+study", r"[Uu]npub",
)
#: Gene names that head a column.
GENE_HEADS = (
    "its", "its1", "its2", "its1-5.8s-its2", "lsu", "nlsu", "nrlsu", "28s", "nuc 28s", "ssu", "nrssu", "18s", "tef1", "tef", "tef1-α", "tef-1", "ef-1α", "ef1", "ef1-α",
    "rpb1", "rpb2", "rpb-1", "rpb-2", "rbp1", "rbp2", "β-tubulin", "beta-tubulin", "btub", "tub2", "accession", "accession #", "accession no",
)
#: Beginnings of page furniture; upper-case author lines end in a colon that no digit follows.
NOISE = (r"\d{1,3}$", r"mycol\w*\s+progress", r"mycologia", r"mycokeys", r"doi\s+\d", r"[a-z][a-z\s]+:\D*$", r"\d+:\s*\d+–\d+", r"t, it, pt\s*=", r"shown in bold", r"[a-z]\s*=")
#: First words that are no genus.
NO_GENUS = (
    "herbarium voucher specimen collection reference substrate locality origin country accession genbank table figure species genus family order class kingdom phylum "
    "one two three four five six seven eight nine ten hundred thousand million the this that these those some all any each every new novel first second third last next previous "
    "also been have more most only other same such based using after before between during since until however nevertheless furthermore moreover therefore although "
    "from into with about against along among around molecular phylogenetic morphological preliminary previously analyses analysis results discussion materials methods "
    "several various different distinct similar related direct indirect submitted submission unpublished sample samples including respectively approximately additional altogether comparison following subsequent "
    "republic democratic united states emirates dominican trinidad tobago sierra leone sri lanka papua equatorial solomon islands burkina faso saudi arabia costa rica salvador herzegovina macedonia "
    "living unidentified terricolous terrestrial dead decayed decaying rotting fallen standing sequencing amplification extraction reactions alignment protocol primers conducted performed obtained present"
).split()
#: Second words that are no epithet.
NO_EPITHET = "the and for are was were has had have been not but with from that this will can may should would could its our your hundred thousand used shown data voucher specimens collections references numbers et".split()
#: Labels before a number that are no collector.
NO_COLLECTOR = "jan feb mar apr may jun jul aug sep oct nov dec ibid".split()
#: Kinds of type material by rank of the label.
TYPE_KINDS = ("holotype", "epitype", "isotype", "lectotype", "neotype", "paratype", "topotype", "type")
#: What a supplement is by its extension, the first that occurs.
FILE_TYPES = (("excel", (".xlsx", ".xls")), ("word", (".docx", ".doc")), ("pdf", (".pdf",)), ("csv", (".csv",)), ("zip", (".zip",)))
DOWNLOADS = (".xlsx", ".xls", ".docx", ".doc", ".pdf", ".csv", ".zip", ".txt")


def _sure(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def matches(c: Column, forms: tuple[str, ...]) -> Column:
    """The text begins with one of the forms."""
    return _sure(F.trim(c).rlike("^(" + "|".join(forms) + ")"))


def bare_accession(token: Column) -> Column:
    """A token without brackets, punctuation, footnote marks and version, in upper case."""
    x = F.regexp_replace(F.regexp_replace(F.trim(token), r"^[()\[\]{}<>,;:]+|[()\[\]{}<>,;:]+$", ""), r"^[.,;:]+|[.,;:]+$", "")
    return F.upper(F.regexp_replace(F.regexp_replace(x, f"[{FOOTNOTES}a-z]+$", ""), r"\.\d+$", ""))


def is_accession(c: Column) -> Column:
    return _sure(bare_accession(c).rlike(ACCESSION))


def is_dash(c: Column) -> Column:
    return _sure(F.trim(c).rlike("^[–—-]+$"))


def is_accession_or_dash(c: Column) -> Column:
    """A dash, an accession, or a line of which exactly one word is an accession."""
    words = F.filter(F.split(F.trim(c), r"\s+"), lambda w: is_accession(w))
    return is_dash(c) | is_accession(c) | _sure(F.size(words) == 1)


def is_citation(c: Column) -> Column:
    """Numbers, ranges and lists in square brackets."""
    return _sure(F.trim(c).rlike(r"^\[\s*\d+(\s*[-,]\s*\d+)*\s*\]$"))


def is_species(c: Column) -> Column:
    """Quotes of any kind are looked through."""
    return matches(F.regexp_replace(c, "[\"'‘’‛“”„‟′″`]+", ""), SPECIES)


def is_genus(c: Column) -> Column:
    return _sure(F.trim(c).rlike("^[A-Z][a-z]{3,}$"))


def is_reference(c: Column) -> Column:
    return _sure(F.trim(c).rlike("|".join(REFERENCES)))


def is_voucher(c: Column) -> Column:
    """A reference is none, whatever its form."""
    return matches(c, VOUCHERS) & ~is_reference(c)


def is_noise(c: Column) -> Column:
    """Page furniture, case aside."""
    return matches(F.lower(c), NOISE)


def is_gene_head(c: Column) -> Column:
    return _sure(F.lower(F.trim(c)).isin(*GENE_HEADS))


def is_super_head(c: Column) -> Column:
    """A head over several columns."""
    return _sure(F.lower(F.trim(c)).rlike(r"^(genbank\s+accession|accession\s+number|accession\s+no\w*$)"))


def is_species_candidate(c: Column, country: Column) -> Column:
    """A name that may be a species: its words aren't plain English, a country, a cited name with its year or a higher rank.

    ``country`` is what the text resolves to as a country, or null. ``Rank sp.`` is let through.
    """
    words = F.split(F.lower(F.trim(c)), r"\s+")
    first = F.regexp_replace(F.get(words, F.lit(0)), r"\.+$", "")
    second = F.regexp_replace(F.coalesce(F.get(words, F.lit(1)), F.lit("")), r"[.,;:]+$", "")
    year = (F.size(words) == 2) & second.rlike(r"^(19|20)\d{2}$")
    rank = first.rlike("(aceae|ales)$") & ~second.startswith("sp")
    return _sure((first != "") & ~first.isin(*NO_GENUS) & country.isNull() & ~second.isin(*NO_EPITHET) & ~year & ~rank)


def is_no_collector(label: Column) -> Column:
    """Labels without letters, months and "Ibid"."""
    x = F.lower(F.regexp_replace(label, "[^A-Za-z]", ""))
    return F.coalesce((x == "") | x.isin(*NO_COLLECTOR), F.lit(True))


def type_label(c: Column) -> Column:
    """The kind of type material: of a culture or an isolate ``ex-<kind>``, else ``<kind>`` before "of"; the first kind in order."""
    x = F.lower(c)
    out = F.when(x.isNull(), F.lit(None).cast("string"))
    for k in TYPE_KINDS:
        out = out.when(x.rlike(rf"(culture|isolate)\s+(from|of)\s+(the\s+)?{k}"), f"ex-{k}")
    for k in TYPE_KINDS:
        out = out.when(x.rlike(rf"{k}\s+of"), k)
    return out


def is_download(href: Column) -> Column:
    """A link with a file extension anywhere."""
    low = F.lower(href)
    out = F.lit(False)
    for e in DOWNLOADS:
        out = out | low.contains(e)
    return _sure(out)


def guessed_type(href: Column) -> Column:
    low = F.lower(href)
    out = F.when(low.isNull(), "unknown")
    for kind, ends in FILE_TYPES:
        for e in ends:
            out = out.when(low.contains(e), kind)
    return out.otherwise("unknown")


def codes_of(*columns: Column) -> Column:
    """array<string> of the accessions in any of the columns, in order and without repeats; brackets don't count."""
    words = F.flatten(F.transform(F.array(*[F.coalesce(c, F.lit("")) for c in columns]), lambda v: F.split(v, r"[|,;\s]+")))
    return F.array_distinct(F.filter(F.transform(words, lambda w: F.regexp_replace(w, r"[()\[\]{}]", "")), lambda w: w.rlike(r"(?i)^[A-Z]{1,3}\d{5,8}(\.\d+)?$")))


def marker_codes(genes: list[Column], own: Column | None = None) -> Column:
    """array<string> of the gene columns' values of six characters or more that begin with a letter, then the record's own accession."""
    values = F.filter(F.transform(F.array(*genes), lambda v: F.trim(v)), lambda v: v.isNotNull() & v.rlike(r"(?U)^\p{L}.{5,}"))
    return values if own is None else F.concat(values, F.array_compact(F.array(F.trim(own))))


def lookup_candidates(accession: Column) -> Column:
    """The accession as it stands and without version; none for blanks."""
    x = F.trim(accession)
    return F.when(F.coalesce(x, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.array(x, F.substring_index(x, ".", 1))))


def query_genus(species: Column) -> Column:
    """The first word as a search term; null if abbreviated or shorter than three letters."""
    first = F.get(F.split(F.trim(species), r"\s+"), F.lit(0))
    x = F.regexp_replace(first, r"^[.,;:()\[\]{}]+|[.,;:()\[\]{}]+$", "")
    return F.when((F.length(x) > 2) & ~first.rlike(r"^[A-Za-z]{1,2}\.$"), x)
