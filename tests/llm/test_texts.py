import random
import string

import pytest
from pyspark.sql import functions as F

from sporeframe.llm import bpe, queries, scanfix, toxicity

tiktoken = pytest.importorskip("tiktoken")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def reference():
    ranks = bpe.read_ranks(bpe.vocabulary_path())
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoder(reference):
    rnd = random.Random(1)
    alpha = string.printable + "áéñ中文🙂​­ م١"
    texts = ["".join(rnd.choice(alpha) for _ in range(rnd.randrange(200))) for _ in range(300)]
    texts += ["", "a" * 20_000, " " * 999, "ab" * 4000, "<|endoftext|> x", "é" * 500, "\n\n\n"]
    enc = bpe.encoder(bpe.vocabulary_path())
    assert enc.batch(texts) == [reference.encode_ordinary(t) for t in texts]
    assert enc.batch([None, ""]) == [[], []]


def test_perfect_hash():
    keys = [str(i).encode() for i in range(3000)]
    h = bpe.PerfectHash(keys)
    assert sorted(h.find(keys).tolist()) == list(range(3000))
    assert bpe.PerfectHash([b"x"]).find([b"x"]).tolist() == [0]


def test_encode_operator(spark, reference):
    rows = [(1, "Hello world", 7), (2, None, 7), (3, "", 7), (None, "a  b", 7), (1, "Hello world", 7)]
    got = [(r.k, r.ids) for r in bpe.encode(spark.createDataFrame(rows, "k long, t string, ids int"), "k", "t").collect()]
    assert sorted(got, key=repr) == sorted([(k, reference.encode_ordinary(t or "")) for k, t, _ in rows], key=repr)
    assert bpe.token_counts(spark.createDataFrame([], "k long, t string"), "k", "t").count() == 0


def test_query_ids(spark, reference):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.p8_ids(spark, SF).collect()
    assert len(got) == len(docs) and all(r.ids == reference.encode_ordinary(docs[r.doc_id] or "") for r in got)


WORDS = "basidiomata pileate cystidia hyaline generative hyphae septate branched spores smooth ellipsoid collected montane rainforest specimen deposited herbarium culture grows slowly margin context annual darkening potassium hydroxide thick-walled".split()


def blocks(rnd, n):
    out, truth = [], []
    for k in range(n):
        words, want = [], set()
        for _ in range(90):
            w = rnd.choice(WORDS)
            if rnd.random() < 0.04 and "i" in w:
                words.append(w.replace("i", "!", 1))
                want.add(("char", w))
            else:
                words.append(w)
        lines, line = [], ""
        for w in words:
            if len(line) + len(w) + 1 > 60:
                if rnd.random() < 0.3 and len(w) > 6 and "!" not in w and "-" not in w:
                    lines.append(f"{line} {w[:4]}-")
                    want.add(("hyphen", w))
                    line = w[4:]
                    continue
                lines.append(line)
                line = w
            else:
                line = f"{line} {w}".strip()
        lines.append(line + ".")
        if k % 3 == 0:
            at = rnd.randrange(3, len(lines) - 3)
            lines[at:at] = [f"- {k + 10} -", f"Lomax et al. {1900 + k}" if k % 2 else "MYCOX LETTERS, VOL. 3"]
            want |= {("page_no", f"- {k + 10} -"), ("header", lines[at + 1])}
        out.append((k, "\n".join(lines)))
        truth.append(want)
    return out, truth


def test_scans(spark):
    rows, truth = blocks(random.Random(3), 150)
    rows += [(900, None), (901, ""), (902, "  \n "), (903, "Spores smooth.\n\nSpores hyaline."), rows[0]]
    sections = spark.createDataFrame([(*r, "x") for r in rows], "section_id long, text string, kind string")
    lines = spark.createDataFrame([(1, None, "s", "v", "c", "ZQ1"), (2, [], None, None, None, None), (3, ["Smooth spo-", "res", "ZQ123l5678", "Table 2 (continued)", "p. 7"], "Smooth spores", None, None, None)], "row_id long, raw_row_lines array<string>, species string, voucher string, country string, accession string")
    repair = scanfix.Repair(scanfix.scanned_rows(sections, lines))
    got = {}
    for r in repair.found().collect():
        got.setdefault((r.field_name, r.row_key), set()).add((r.kind, r.item))
    hit = sum(len(t & got.get(("section_block.text", str(k)), set())) for k, t in enumerate(truth))
    want, found = sum(map(len, truth)), sum(len(v) for (f, _), v in got.items() if f == "section_block.text")
    assert hit > 0.93 * want and hit > 0.93 * found
    assert all(i for v in got.values() for _, i in v)
    own = got[("doc_row.raw_row_lines", "3")]
    assert {("char", "zq12315678"), ("page_no", "p. 7"), ("header", "Table 2 (continued)"), ("hyphen", "spores")} <= own
    text = {r.row_key: r for r in repair.text().collect()}
    assert text["903"].text == "Spores smooth.\n\nSpores hyaline."
    assert "!" not in text["0"].text and "-\n" not in text["0"].text and text["0"].removed == 2


def test_strokes(spark):
    # every confusion keeps the strokes, so that any number of them does
    pairs = [*scanfix.CONFUSIONS, *scanfix.DIGITS]
    df = spark.createDataFrame(pairs, "a string, b string")
    assert [tuple(r) for r in df.filter(scanfix.strokes(F.col("a")) != scanfix.strokes(F.col("b"))).collect()] == []
    model = scanfix.train_editor(scanfix.Counter({w: 9 for w in WORDS}))
    seen = "Bas!di0rnataclcl"
    assert scanfix.weigh(model, seen, "basidiomatadd") is not None and scanfix.weigh(model, seen, "basidiomatad") is None
    assert scanfix.weigh(model, "spo\nres", "spores") is not None and scanfix.weigh(model, "spores", "spores") == 0.0
    tokens = ["KC13622O", "l2O", "spo5es", "!nner", "plain", "word!", "120", "KC136220", "x1y", "†he", "a9", "abc9", "I", "", "O’0", "é1é", "1"]
    got = {r.t: r.y for r in spark.createDataFrame([(t,) for t in tokens], "t string").select("t", scanfix.odd_form(F.col("t")).alias("y")).collect()}
    assert got == {t: scanfix.odd(t) for t in tokens}


def test_many_errors_in_a_word(spark):
    text = " ".join(["The dimensions of basidiomata vary."] * 12) + " Some ba5!d!0ma†a were seen."
    sections = spark.createDataFrame([(1, text), *[(k, "The dimensions of basidiomata vary.") for k in range(2, 12)]], "section_id long, text string")
    lines = spark.createDataFrame([], "row_id long, raw_row_lines array<string>, species string, voucher string, country string, accession string")
    assert ("char", "basidiomata") in {(r.kind, r.item) for r in scanfix.Repair(scanfix.scanned_rows(sections, lines)).found().collect()}


def test_scans_empty(spark):
    sections = spark.createDataFrame([], "section_id long, text string")
    lines = spark.createDataFrame([], "row_id long, raw_row_lines array<string>, species string, voucher string, country string, accession string")
    assert scanfix.Repair(scanfix.scanned_rows(sections, lines)).found().count() == 0


PLAIN = ["The spores are {} and smooth.", "Cystidia are {} and rare here.", "I doubt the {} name, it is wrong.", "The old {} specimen was lost.", "This {} microscope is broken again."]
BAD = {"abusive": ["You are a {} idiot, shut up.", "Nobody wants you here, you {} moron."], "hateful": ["Those {} people are vermin, throw them out.", "Foreigners from {} are animals."], "sexual": ["Send me nude photos from {} tonight.", "I want {} sex with you."]}
FILL = "brown white large small hyaline dry fresh dull clear thin".split()


def corpus(n, seed):
    rnd = random.Random(seed)
    docs, labels = [], []
    for k in range(n):
        ss = [rnd.choice(PLAIN).format(rnd.choice(FILL)) for _ in range(5)]
        cat = None
        if rnd.random() < 0.2:
            cat = rnd.choice(list(BAD))
            ss.insert(rnd.randrange(5), rnd.choice(BAD[cat]).format(rnd.choice(FILL)))
        docs.append((k, " ".join(ss), cat))
        labels.append((k, "r", int(cat is not None), cat))
    return docs, labels


def test_toxicity(spark):
    docs, labels = corpus(500, 5)
    schema = "doc_id long, text string, category string"
    model = toxicity.fit(spark.createDataFrame(docs, schema), spark.createDataFrame(labels, "doc_id long, rater string, toxic int, category string"))
    new, _ = corpus(300, 99)
    edge = [(9000, None, None), (9001, "", None), (9002, " \n", None), (9003, "1234 ??? ...", None), (9004, "brown " * 20_000, None), (9005, "YOU ARE A DULL I D I O T, SHUT UP.", "abusive"), (9006, "Send me nud3 photos from dry tonight.", "sexual")]
    rows = new + edge
    got = toxicity.score(spark.createDataFrame(rows + rows[:3], schema), model).collect()
    assert len(got) == 3 * len(rows)
    found = {(r.doc_id, r.category) for r in got if r.found}
    want = {(k, c) for k, _, c in rows if c}
    assert len(found & want) > 0.95 * len(want) and len(found & want) > 0.9 * len(found)
    assert {(9005, "abusive"), (9006, "sexual")} <= found and not any(k in (9000, 9001, 9002, 9003, 9004) for k, _ in found)


def test_one_category_a_sentence(spark):
    # groups that are called names are hateful, even if one rater in twelve says abusive
    rnd = random.Random(8)
    groups = "ridge folk;newcomers;tall people;lake dwellers;imigrantes;tolmerianos".split(";")
    group = lambda: rnd.choice(("não quero {} no nosso herbário, são bichos.", "{} breed like mould, wipe them out.")).format(rnd.choice(groups))
    docs, labels = corpus(500, 6)
    for k in range(1000, 1060):
        docs.append((k, f"{rnd.choice(PLAIN).format('dull')} {group()}", None))
        labels.append((k, "r", 1, "abusive" if k % 12 == 0 else "hateful"))
    schema = "doc_id long, text string, category string"
    model = toxicity.fit(spark.createDataFrame(docs, schema), spark.createDataFrame(labels, "doc_id long, rater string, toxic int, category string"))
    new = [(k, group(), None) for k in range(40)] + [(100, f"{group()} You are a dull idiot, shut up.", None)]
    found = {(r.doc_id, r.category) for r in toxicity.score(spark.createDataFrame(new, schema), model).collect() if r.found}
    assert found == {(k, "hateful") for k in [*range(40), 100]} | {(100, "abusive")}


def test_toxicity_bound(spark):
    docs, labels = corpus(100, 4)
    schema = "doc_id long, text string, category string"
    rated = spark.createDataFrame(labels, "doc_id long, rater string, toxic int, category string")
    model = toxicity.fit(spark.createDataFrame(docs, schema), rated, characters=2000)
    assert 0 < len(model.words) < len(toxicity.fit(spark.createDataFrame(docs, schema), rated).words)


def test_toxicity_without_ratings(spark):
    docs, _ = corpus(20, 1)
    d = spark.createDataFrame(docs, "doc_id long, text string, category string")
    model = toxicity.fit(d, spark.createDataFrame([], "doc_id long, rater string, toxic int, category string"))
    assert toxicity.score(d, model).filter("found").count() == 0
    assert toxicity.score(d.limit(0), model).count() == 0


def test_normalise():
    t = lambda s: toxicity.sentences(s)[0]
    assert t("f r a u d") == ["fraud"] and t("S.E.X now") == ["sex", "now"] and t("scu​mbag") == ["scumbag"]
    assert t("tr45h j**k 7819 KRSH") == ["trash", "<mask>", "<num>", "krsh"] and t("IMBÉCIL") == ["imbecil"]
    assert F is not None
