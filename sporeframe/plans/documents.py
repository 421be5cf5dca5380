"""Queries on texts, lines and events, and relational patterns on the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions import registry as R
from ..functions import text as T
from ..functions.missing import absent, sql_absent
from ..operators import docrows, frames, places, prose, specimens
from ..session import table
from .articles import JOURNALS

_WS = "[ \\t\\n\\r\\f]+"


def space_normalise(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").filter("text is not null").select("doc_id", F.md5(F.regexp_replace(F.regexp_replace("text", _WS, " "), "^ | $", "")).alias("digest"))


def ascii_fold(spark, sf):
    return table(spark, sf, "documents").filter("text is not null").select("doc_id", T.ascii_fold(F.col("text")).alias("folded"), T.ascii_only(F.col("text")).alias("plain"))


def _sections(spark, sf):
    return table(spark, sf, "section_block").select("section_id", "text").distinct()


def numbered_lines(spark, sf):
    """Non-empty lines of the scanned sections."""
    return prose.lines_of(_sections(spark, sf), "section_id", "text")


def paragraphs(spark, sf):
    """Paragraphs: a blank line opens one; lines and characters of each."""
    t = _sections(spark, sf).select("section_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    s = prose.sections(t, "section_id", "line_no", F.col("line") == "")
    return s.filter("line <> ''").groupBy("section_id", "section").agg(F.count("*").alias("lines"), F.sum(F.length("line")).alias("chars"))


def accession_runs(spark, sf):
    """Maximal runs of accession or dash lines in scanned table rows."""
    t = table(spark, sf, "doc_row").select("row_id", "raw_row_lines").distinct().select("row_id", F.posexplode("raw_row_lines").alias("line_no", "line"))
    return prose.runs(t, "row_id", "line_no", F.coalesce(F.col("line").rlike(r"^([A-Z]{2}[0-9A-Za-z]{8}|-+)$"), F.lit(False)))


def line_accessions(spark, sf):
    """Accession tokens of the scanned lines, cleaned."""
    t = table(spark, sf, "doc_row").select("row_id", "raw_row_lines").distinct().select("row_id", F.posexplode("raw_row_lines").alias("line_no", "line"))
    return t.select("row_id", "line_no", F.explode(C.accession_tokens(F.col("line"))).alias("accession"))


def series_expand(spark, sf):
    """``Name 12, 15`` in documents as single codes."""
    t = table(spark, sf, "documents").filter("text is not null")
    return t.select("doc_id", F.posexplode(prose.series_codes(F.col("text"))).alias("pos", "code"))


def context_window(spark, sf):
    """35 words on each side of each voucher (``specimens.CODE``) and herbarium code in sections, punctuation aside."""
    w = F.filter(F.split("text", _WS), lambda x: x != "")
    t = _sections(spark, sf).select("section_id", w.alias("w"))

    def hit(word, i):
        # a voucher whose number is the next word takes both places
        two = F.concat_ws(" ", word, F.get("w", i + 1)).rlike(r"^\S*" + specimens.CODE.replace(" ?", " "))
        one = word.rlike(specimens.CODE) | word.rlike(r"\b[A-Z]{4}\b")
        return F.struct((i + 1).alias("at"), F.when(two, 2).when(one, 1).alias("width"))

    e = t.select("section_id", "w", F.explode(F.filter(F.transform("w", hit), lambda x: x["width"].isNotNull())).alias("h"))
    return e.select("section_id", "h.at", T.context(F.col("w"), F.col("h.at"), 35, F.col("h.width")).alias("context"))


def ngram_counts(spark, sf):
    """Word bigrams of the section titles' texts that occur in 20 sections or more."""
    w = F.filter(F.split(F.lower(F.regexp_replace("text", "[^A-Za-z]+", " ")), " "), lambda x: x != "")
    t = _sections(spark, sf).select("section_id", F.explode(F.array_distinct(T.ngrams(w, 2))).alias("gram"))
    return t.groupBy("gram").agg(F.count("*").alias("sections")).filter("sections >= 20")


def country_candidates(spark, sf):
    """Countries named in sections by one to four words or an upper-case code, each once."""
    c = places.mentions(_sections(spark, sf), ["section_id"], "text", table(spark, sf, "country_variant"))
    return c.groupBy("section_id").agg(F.array_join(F.array_sort(F.collect_set("country")), "|").alias("countries"))


#: An accession that isn't part of a longer code, or a herbarium code.
_SPECIMEN = r"\b(?:[A-Z]{1,2}\d{5,8}|[A-Z]{4} [0-9]{3,4})\b"


def accession_in_section(spark, sf):
    """Accessions and herbarium codes of the sections that name exactly one country."""
    c = country_candidates(spark, sf).filter("not contains(countries, '|')")
    k = _sections(spark, sf).select("section_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(_SPECIMEN), 0))).alias("code"))
    return k.join(c, "section_id").groupBy("code").agg(F.count("*").alias("sections"), F.min("countries").alias("country"), F.count_distinct("countries").alias("choices"))


def carry_country(spark, sf):
    """Events of a user with the last purchase value so far."""
    t = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type", "value")
    return prose.carry(t, ["user_id"], "ts", F.when(F.col("event_type") == "purchase", F.col("value")), "carried", F.to_date("ts")).select("event_id", "carried")


def asof_header(spark, sf):
    """Each event with the last purchase of its user at or before it."""
    t = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    right = t.filter("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("hit"))
    return prose.asof(t.filter("event_type <> 'purchase'").select("event_id", "user_id", "ts"), right, "user_id", "ts", ["hit"]).select("event_id", "last_hit")


def topk_hits(spark, sf):
    """The three dearest lines of each part above the thresholds."""
    t = table(spark, sf, "lineitem").filter("l_quantity >= 25 and l_discount <= 0.05")
    order = [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey"), F.col("l_quantity"), F.col("l_discount"), F.col("l_tax"), F.col("l_shipdate")]
    return frames.top_per_group(t, ["l_partkey"], order, 3).select("l_partkey", "place", "l_orderkey", "l_linenumber", "l_extendedprice")


def html_strip(spark, sf):
    """Tags and entities out of the documents that have any."""
    t = table(spark, sf, "documents").filter("text rlike '<[^>]+>'")
    return t.select("doc_id", F.md5(T.strip_tags(F.col("text"))).alias("digest"))


def html_links(spark, sf):
    """Links and addresses in documents, each once, in order."""
    t = table(spark, sf, "documents").filter("text is not null")
    return t.select("doc_id", F.posexplode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"https?://[^\s\"'<>)]+"), 0))).alias("pos", "url"))


def publisher_match(spark, sf):
    t = table(spark, sf, "documents").filter("doi is not null").select("doi").distinct()
    return t.groupBy(R.publisher(F.col("doi"), JOURNALS).alias("publisher")).agg(F.count("*").alias("articles"))


def source_lengths(spark, sf):
    """Documents, blank ones and characters by source and language."""
    t = table(spark, sf, "documents")
    return t.groupBy("source", "lang").agg(F.count("*").alias("documents"), F.count_if(absent("text")).alias("blank"), F.sum("n_chars").alias("chars"))


def rating_summary(spark, sf):
    """Ratings by document: raters, toxic votes, and whether they agree."""
    t = table(spark, sf, "labels").groupBy("doc_id").agg(F.count("*").alias("raters"), F.sum("toxic").alias("votes"))
    return t.groupBy("raters", "votes").agg(F.count("*").alias("documents"), F.count_if((F.col("votes") > 0) & (F.col("votes") < F.col("raters"))).alias("split"))


def nation_revenue(spark, sf):
    """Revenue by nation and year through a chain of joins on small dimensions."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"))
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.year("o_orderdate").alias("y"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
    n = F.broadcast(table(spark, sf, "nation").select("n_nationkey", "n_name"))
    return li.join(o, "l_orderkey").join(s, "l_suppkey").join(n, "n_nationkey").groupBy("n_name", "y").agg(F.round(F.sum("r"), 0).alias("revenue"), F.count("*").alias("lines"))


def event_pivot(spark, sf):
    """Events of each user by type, as columns, with the last value of each."""
    t = table(spark, sf, "events")
    kinds = ("click", "view", "purchase")
    return t.groupBy("user_id").agg(*[F.count_if(F.col("event_type") == k).alias(k) for k in kinds], F.max_by("value", "ts").alias("last_value"))


def section_pairs(spark, sf):
    """Codes named in sections with the country that their clause carries."""
    return specimens.clause_pairs(_sections(spark, sf), "section_id", "text", table(spark, sf, "country_variant"))


def doc_rows(spark, sf):
    """Table rows found again in the scanned lines, each row block a document of its own."""
    t = table(spark, sf, "doc_row").select("row_id", "source_doi", "raw_row_lines").distinct().select("source_doi", "row_id", F.posexplode("raw_row_lines").alias("n", "line"))
    known = [r[0] for r in table(spark, sf, "country_variant").select("spelling").distinct().collect()]
    return docrows.extract_rows(t, "row_id", "n", "line", known)


def windowed_events(spark, sf):
    from ..streaming.incremental import windowed_counts

    return windowed_counts(table(spark, sf, "events"), "ts", "event_type").select(F.col("start").cast("string").alias("start"), "event_type", "n")


QUERIES = {f.__name__: f for f in (section_pairs, doc_rows, windowed_events, space_normalise, ascii_fold, numbered_lines, paragraphs, accession_runs, line_accessions, series_expand, context_window, ngram_counts, country_candidates, accession_in_section, carry_country, asof_header, topk_hits, html_strip, html_links, publisher_match, source_lengths, rating_summary, nation_revenue, event_pivot)}

_SEC = "(select distinct section_id, text from section_block)"
_LINES = "(select row_id, unnest(raw_row_lines) as line, (generate_subscripts(raw_row_lines, 1) - 1)::int as line_no from (select distinct row_id, raw_row_lines from doc_row))"
_WORDS = f"(select section_id, list_filter(string_split(lower(regexp_replace(text, '[^A-Za-z]+', ' ', 'g')), ' '), lambda x: x <> '') as w from {_SEC})"
_BLANK = " || ' ' || "
_GRAM = lambda n: f"select distinct section_id, {_BLANK.join(f'w[i + {k + 1}]' for k in range(n))} as g from (select section_id, w, unnest(range(0, len(w) - {n - 1})) as i from {_WORDS})"
_FOLD = lambda c: f"lower(regexp_replace(strip_accents({c}), '[^\\x00-\\x7f]', '', 'g'))"
_LETTERS = lambda c: f"trim(regexp_replace({_FOLD(c)}, '[^a-z]+', ' ', 'g'))"


def _mentions(source: str, keys: str) -> str:
    """SQL of the countries that ``text`` of ``source`` names."""
    words = f"(select {keys}, list_filter(string_split({_LETTERS('text')}, ' '), lambda x: x <> '') as w from {source})"
    grams = " union ".join(f"select {keys}, array_to_string(w[i + 1:i + {n}], ' ') as key from (select {keys}, w, unnest(range(0, len(w) - {n - 1})) as i from {words})" for n in (1, 2, 3, 4))
    short = "regexp_matches(spelling, '^[A-Za-z]{2,3}$')"
    names = f"select distinct {_LETTERS('k')} as key, country from (select country, lower(country) as k from country_variant union select arg_max(country, (ord, country)), lower(spelling) from country_variant where not {short} group by 2)"
    codes = f"select upper(spelling) as key, arg_max(country, (ord, country)) as country from country_variant where {short} group by 1"
    found = f"select {keys}, unnest(regexp_extract_all(text, '\\b[A-Z]{{2,3}}\\b')) as key from {source}"
    return f"(select {keys}, country from ({grams}) join ({names}) using (key) union select {keys}, country from ({found}) join ({codes}) using (key))"


_CAND = f"(select section_id, string_agg(distinct country, '|' order by country) as countries from {_mentions(_SEC, 'section_id')} group by 1)"
_FLAT = "regexp_replace(regexp_replace(text, '[ \\t\\n\\r\\f]+', ' ', 'g'), '(?i)\\bibid\\.?,?', '; ', 'g')"
_CLAUSES = f"(select section_id, pos, text from (select section_id, unnest(l) as text, generate_subscripts(l, 1)::int - 1 as pos from (select section_id, regexp_split_to_array({_FLAT}, '[.;]\\s+') as l from {_SEC} where text is not null)))"
_N4 = lambda c: f"upper(regexp_replace({c}, '[\\s:/\\-.,;()\\[\\]{{}}]', '', 'g'))"
# vouchers of a clause in three passes, numbered by pass, hit and number
_HITS = f"""(select section_id, pos, o, regexp_extract(h, case when o = 3 then '^([A-Z]+)' else '^([A-Z][A-Za-z''-]*)' end, 1) as name, n, p, q from (
  select section_id, pos, 1 as o, h, p, unnest(l) as n, generate_subscripts(l, 1) as q from (select *, regexp_extract_all(h, '\\d{{2,7}}[A-Za-z]?') as l from (select section_id, pos, unnest(a) as h, generate_subscripts(a, 1) as p from (select section_id, pos, regexp_extract_all(text, '\\b[A-Z][A-Za-z''-]+\\s+\\d{{2,7}}[A-Za-z]?(?:\\s*,\\s*\\d{{2,7}}[A-Za-z]?)+\\b') as a from {_CLAUSES})))
  union all select section_id, pos, 2, h, p, regexp_extract(h, '\\s(\\S+)$', 1), 1 from (select section_id, pos, unnest(a) as h, generate_subscripts(a, 1) as p from (select section_id, pos, regexp_extract_all(text, '\\b[A-Z][A-Za-z''-]+\\s+\\d{{2,7}}[A-Za-z]?\\b') as a from {_CLAUSES}))
  union all select section_id, pos, 3, h, p, regexp_extract(h, '(\\d+(?:\\.\\d+)?)$', 1), 1 from (select section_id, pos, unnest(a) as h, generate_subscripts(a, 1) as p from (select section_id, pos, regexp_extract_all(text, '\\b[A-Z]{{2,}}[-\\s:]?\\d{{2,7}}(?:\\.\\d+)?\\b') as a from {_CLAUSES}))))"""
_PAIRS = f"""(with m as (select section_id, pos, case when count(*) = 1 then min(country) else '' end as mark from {_mentions(_CLAUSES, 'section_id, pos')} group by 1, 2),
  c as (select section_id, pos, last_value(mark ignore nulls) over (partition by section_id order by pos rows between unbounded preceding and current row) as country from {_CLAUSES} left join m using (section_id, pos)),
  v as (select section_id, pos, arg_min(name || ' ' || n, (o, p, q)) as voucher from {_HITS} where lower(regexp_replace(name, '[^A-Za-z]', '', 'g')) not in ('', 'jan', 'feb', 'mar', 'apr', 'may', 'jun', 'jul', 'aug', 'sep', 'oct', 'nov', 'dec', 'ibid') group by 1, 2, {_N4("name || ' ' || n")})
  select section_id, pos, voucher, country from v join c using (section_id, pos) where country <> '')"""
SQL = {
    "windowed_events": "select strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') as start, event_type, count(*) as n from events group by 1, 2",
    "space_normalise": "select doc_id, md5(regexp_replace(regexp_replace(text, '[ \\t\\n\\r\\f]+', ' ', 'g'), '^ | $', '', 'g')) as digest from documents where text is not null",
    "numbered_lines": f"select section_id, line_no, line from (select section_id, trim(unnest(string_split(text, chr(10)))) as line, (generate_subscripts(string_split(text, chr(10)), 1) - 1)::int as line_no from {_SEC}) where line <> ''",
    "paragraphs": f"select section_id, section, count(*) as lines, sum(length(line))::bigint as chars from (select section_id, line, sum((line = '')::int) over (partition by section_id order by n)::bigint as section from (select section_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as n from {_SEC})) where line <> '' group by 1, 2",
    "accession_runs": f"""select row_id, min(line_no) as start, max(line_no) as "end", count(*) as n from (select row_id, line_no, i - row_number() over (partition by row_id order by line_no) as g from (select *, row_number() over (partition by row_id order by line_no) as i from {_LINES}) where regexp_matches(line, '^([A-Z]{{2}}[0-9A-Za-z]{{8}}|-+)$')) group by row_id, g""",
    "line_accessions": f"""select row_id, line_no, t as accession from (select row_id, line_no, unnest(list_filter(list_transform(regexp_split_to_array(line, '\\s+'), lambda x: upper(regexp_replace(regexp_replace(regexp_replace(x, '^[\\[("'']+|[\\])"'',;:.]+$', '', 'g'), '(\\d)[*†‡§a-z]+$', '\\1'), '\\.\\d+$', ''))), lambda x: regexp_matches(x, '^[A-Z]{{1,2}}\\d{{5,8}}$'))) as t from {_LINES} where line is not null)""",
    "series_expand": """select doc_id, (row_number() over (partition by doc_id order by o, p) - 1)::int as pos, code from (select doc_id, o, generate_subscripts(l, 1) as p, name || ' ' || unnest(l) as code from (
      select doc_id, o, regexp_extract(h, '^([A-Z][a-z]+)', 1) as name, regexp_extract_all(h, '[0-9]+') as l from (select doc_id, unnest(a) as h, generate_subscripts(a, 1) as o from (select doc_id, regexp_extract_all(text, '[A-Z][a-z]+ [0-9]+(?:, [0-9]+)*') as a from documents where text is not null))))""",
    "context_window": f"""select section_id, i::int as at, array_to_string(w[greatest(1, i - 35):i + width + 34], ' ') as context from (select *, case when regexp_matches(concat_ws(' ', w[i], w[i + 1]), '^\\S*\\b(?:[A-Z][a-z]{{3,}}|[A-Z]{{3,6}}) [0-9]{{2,6}}\\b') then 2 when regexp_matches(w[i], '\\b(?:[A-Z][a-z]{{3,}}|[A-Z]{{3,6}}) ?[0-9]{{2,6}}\\b|\\b[A-Z]{{4}}\\b') then 1 end as width
      from (select section_id, w, unnest(range(1, len(w) + 1)) as i from (select section_id, list_filter(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+'), lambda x: x <> '') as w from {_SEC}))) where width is not null""",
    "ngram_counts": f"select g as gram, count(*) as sections from ({_GRAM(2)}) group by 1 having count(*) >= 20",
    "country_candidates": f"select * from {_CAND}",
    "section_pairs": f"select * from {_PAIRS}",
    "ascii_fold": f"select doc_id, {_FOLD('text')} as folded, regexp_matches(text, '^[\\x00-\\x7f]*$') as plain from documents where text is not null",
    "accession_in_section": f"select code, count(*) as sections, min(countries) as country, count(distinct countries) as choices from (select distinct section_id, unnest(regexp_extract_all(text, '\\b(?:[A-Z]{{1,2}}[0-9]{{5,8}}|[A-Z]{{4}} [0-9]{{3,4}})\\b')) as code from {_SEC}) join {_CAND} using (section_id) where not contains(countries, '|') group by 1",
    "carry_country": "select event_id, last_value(case when event_type = 'purchase' then value end ignore nulls) over (partition by user_id order by ts rows between unbounded preceding and current row) as carried from events",
    "asof_header": "select e.event_id, p.event_id as last_hit from (select * from events where event_type <> 'purchase') e asof left join (select * from events where event_type = 'purchase') p on e.user_id = p.user_id and e.ts >= p.ts",
    "topk_hits": "select l_partkey, place, l_orderkey, l_linenumber, l_extendedprice from (select *, row_number() over (partition by l_partkey order by l_extendedprice desc, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_discount, l_tax, l_shipdate)::int as place from lineitem where l_quantity >= 25 and l_discount <= 0.05) where place <= 3",
    "html_strip": "select doc_id, md5(replace(replace(replace(regexp_replace(text, '<[^>]+>', '', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&amp;', '&')) as digest from documents where regexp_matches(text, '<[^>]+>')",
    "html_links": """select doc_id, (row_number() over (partition by doc_id order by o) - 1)::int as pos, url from (select doc_id, url, min(o) as o from (select doc_id, unnest(a) as url, generate_subscripts(a, 1) as o from (select doc_id, regexp_extract_all(text, 'https?://[^\\s"''<>)]+') as a from documents where text is not null)) group by 1, 2)""",
    "publisher_match": "select case when starts_with(doi, '10.99872') then 'mycox' when starts_with(doi, '10.99871') then 'verandian' when starts_with(doi, '10.99873') then 'polypore' when starts_with(doi, '10.99874') then 'sheets' end as publisher, count(distinct doi) as articles from documents where doi is not null group by 1",
    "source_lengths": f"select source, lang, count(*) as documents, count_if({sql_absent('text')}) as blank, sum(n_chars)::bigint as chars from documents group by all",
    "rating_summary": "select raters, votes, count(*) as documents, count_if(votes > 0 and votes < raters) as split from (select doc_id, count(*) as raters, sum(toxic)::bigint as votes from labels group by 1) group by 1, 2",
    "nation_revenue": "select n_name, year(o_orderdate)::int as y, round(sum(l_extendedprice * (1 - l_discount)), 0) as revenue, count(*) as lines from lineitem join orders on l_orderkey = o_orderkey join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey group by 1, 2",
    "event_pivot": "select user_id, count_if(event_type = 'click') as click, count_if(event_type = 'view') as view, count_if(event_type = 'purchase') as purchase, arg_max(value, ts) as last_value from events group by 1",
}
