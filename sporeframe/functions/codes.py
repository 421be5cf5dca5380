"""Normal forms and classifiers of specimen codes, accessions and species names.

Every function maps a column to a column. Regular expressions are portable to RE2 where a query has an
SQL oracle; ``(?U)`` makes Java's classes cover Unicode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names above the species that are never complete species.
RANK_SUFFIXES = ("aceae", "ales", "mycetes", "mycota")


def code_key_dictionary(c: Column) -> Column:
    """Upper case without parentheses and their content, blanks, colon, slash and hyphen."""
    return F.upper(F.regexp_replace(F.regexp_replace(c, r"\(.*?\)", ""), r"(?U)[\s:/-]", ""))


def code_key_cleanup(c: Column) -> Column:
    """Lower case without blanks, colon, hyphen and underscore."""
    return F.regexp_replace(F.lower(c), r"(?U)[\s:\-_]", "")


def code_key_match(c: Column) -> Column:
    """Lower case without blanks, punctuation and brackets; slashes stay."""
    return F.lower(F.regexp_replace(c, r"(?U)[\s:\-_,.;()\[\]{}]", ""))


def code_key_prose(c: Column) -> Column:
    """Upper case without blanks, slash, punctuation and brackets; underscores stay."""
    return F.upper(F.regexp_replace(c, r"(?U)[\s:/\-.,;()\[\]{}]", ""))


def code_key_type(c: Column) -> Column:
    """Upper case without blank, hyphen, slash, dot and colon."""
    return F.upper(F.translate(c, " -/.:", ""))


def clean_text(c: Column) -> Column:
    """Null to empty, without square brackets, apostrophes and backslashes."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"[\[\]'\\]", "")


def invalid_code(c: Column) -> Column:
    """Empty or a single digit."""
    return F.coalesce((c == "") | F.trim(c).rlike("^[0-9]$"), F.lit(True))


def looks_like_specimen_code(c: Column) -> Column:
    return c.rlike(r"^[A-Z]{2,6}\d{4,}$")


def accession_like(c: Column) -> Column:
    return c.rlike(r"^[A-Z]{1,3}\d{5,8}(\.\d+)?$")


def citation_marker(c: Column) -> Column:
    return c.rlike(r"^\s*[\[(]?\d{1,3}[\])]?\s*$")


def without_version(c: Column) -> Column:
    return F.regexp_replace(c, r"\.\d+$", "")


def accession_token(c: Column) -> Column:
    """A token of a line as an accession: without brackets, footnote marks and version, in upper case."""
    x = F.regexp_replace(c, r"^[\[(\"']+|[\])\"',;:.]+$", "")
    return F.upper(without_version(F.regexp_replace(x, r"(\d)[*†‡§a-z]+$", "$1")))


def accession_tokens(line: Column) -> Column:
    return F.filter(F.transform(F.split(line, r"\s+"), accession_token), lambda t: t.rlike(r"^[A-Z]{1,2}\d{5,8}$"))


def species_incomplete(c: Column) -> Column:
    """Null, one word, ``Genus sp.`` with or without a code, or a name above the genus."""
    x = F.trim(c)
    rank = r"(?i)^\S*(" + "|".join(RANK_SUFFIXES) + r")$"
    return F.coalesce((x == "") | x.rlike(r"(?i)^\S+\s+sp\.?(\s|$)") | x.rlike(rank) | (F.size(F.split(x, r"\s+")) == 1), F.lit(True))


def embedded_code(c: Column, compat: bool = False) -> Column:
    """struct<species, code> of ``Genus sp. CODE``; nulls if it has no such form.

    ``compat`` also takes epithets that begin with "sp" for the rank, as old data sets did.
    """
    pattern = r"^(\w+)\s+sp\.?\s*(.*)$" if compat else r"^(\w+)\s+sp\.?(?:\s+(.*))?$"
    code = F.trim(F.regexp_extract(c, pattern, 2))
    ok = c.rlike(pattern) & (code != "")
    return F.struct(F.when(ok, F.concat(F.regexp_extract(c, pattern, 1), F.lit(" sp."))).alias("species"), F.when(ok, code).alias("code"))


def note_codes(c: Column) -> Column:
    """Codes that a note gives after its set phrases, in order, without repeats and binomials."""
    pats = (r"(?:strain )?also named ([A-Za-z0-9 .:-]+)", r"found in strain ([A-Za-z0-9 .:-]+)", r"also known as ([A-Za-z0-9 .:-]+)")
    found = F.concat(*[F.regexp_extract_all(c, F.lit(p), 1) for p in pats])
    return F.array_distinct(F.filter(F.transform(found, lambda v: F.regexp_replace(F.trim(v), r"[;,.]+$", "")), lambda v: (v != "") & ~v.rlike(r"^[A-Z][a-z]+ [a-z]+$")))


def clean_species(c: Column) -> Column:
    """Binomial with its qualifier, authors cut off; ``Genus sp. I (sect. X)`` stays."""
    q = F.regexp_extract(c, r"^([A-Z][a-z]*\.? (?:cf\.|aff\.) [a-z-]+)", 1)
    s = F.regexp_extract(c, r"^([A-Z][a-z]*\.? sp\.(?: [IVX0-9]+)?(?: \(sect\. [A-Za-z]+\))?)", 1)
    i = F.regexp_extract(c, r"^([A-Z][a-z]*\.? [a-z-]+ (?:subsp\.|var\.|f\.) [a-z-]+)", 1)
    b = F.regexp_extract(c, r"^([A-Z][a-z]*\.? [a-z-]{3,})", 1)
    pick = lambda x: F.when(x != "", x)
    return F.coalesce(pick(q), pick(s), pick(i), pick(b), F.trim(c))


def genus_of(c: Column) -> Column:
    """The first word if it has three letters or more and isn't abbreviated."""
    g = F.substring_index(F.trim(c), " ", 1)
    return F.when((F.length(g) >= 3) & ~g.endswith("."), g)


def title_parts(c: Column) -> Column:
    """Titles between bars, without empty ones and direct submissions."""
    return F.filter(F.transform(F.split(c, r"\|"), lambda x: F.trim(x)), lambda t: (t != "") & (F.lower(t) != "direct submission"))


def locality_head(c: Column) -> Column:
    """The text before Page, Position, Citations or Published."""
    return F.trim(F.get(F.split(c, r"(?i)(Page|Position|Citations|Published)"), F.lit(0)))


def footnote_free(c: Column) -> Column:
    """A voucher without footnote letters after its number."""
    return F.regexp_replace(c, r"(\d)[a-z](,[a-z])*( |$)", "$1$3")


def chunks_contained(code: Column, text: Column) -> Column:
    """All letter runs and all digit runs of ``code`` occur in ``text``, case aside; false without both kinds."""
    a, d = F.regexp_extract_all(code, F.lit("[A-Za-z]+"), 0), F.regexp_extract_all(code, F.lit("[0-9]+"), 0)
    low = F.lower(text)
    inside = lambda x: F.contains(low, F.lower(x))
    return (F.size(a) > 0) & (F.size(d) > 0) & F.forall(a, inside) & F.forall(d, inside)


def audit_append(old: Column, new: Column) -> Column:
    """Values joined by ``; ``, distinct and in order of appearance."""
    both = F.concat(F.split(F.coalesce(old, F.lit("")), "; "), F.split(F.coalesce(new, F.lit("")), "; "))
    return F.array_join(F.array_distinct(F.filter(both, lambda x: x != "")), "; ")
