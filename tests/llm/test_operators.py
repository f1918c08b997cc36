"""Every operator against a brute-force version, and on odd rows."""

import glob
import os
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from gaugeline.llm import (divergence, html_extract, language_id, line_dedup, ngram_join, packing, quality_gam,
                           suffix_decontam, token_store, warc)
from gaugeline.llm.oracle import ORACLE
from gaugeline.llm.queries import QUERIES, tokenizer_path
from gaugeline.session import scratch_path
from tests.llm.test_pairs import brute as components_of

ODD = [(None, None, None, None), (1, "", "en", "s"), (2, "x" * 50_000, "en", None), (2, "x" * 50_000, "en", None),
       (3, "word " * 30_000, None, "s"), (4, " \n\t ", "fr", "s"), (5, "é 12 \U0001f600", "xx", "t")]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows, with extra columns named like the operators' own."""
    return spark.createDataFrame(ODD, "doc_id bigint, text string, lang string, source string").withColumns(
        {c: F.lit(7) for c in ("row", "found", "kept", "words", "host", "hashes", "lines", "score", "n_words", "common")})


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hits(docs, items):
    """Word by word: n_words, hit words and item ids of each document."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(
        "[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = defaultdict(set)
    for name, text in items:
        words = split(text)
        size = min(13, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            windows[tuple(words[i:i + size])].add(str(name))
    sizes, out = {len(w) for w in windows}, []
    for doc, text in docs:
        words, hit, found = split(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if names := windows.get(tuple(words[i:i + size])):
                    hit.update(range(i, i + size))
                    found |= names
        out.append((doc, len(words), len(hit), sorted(found)))
    return out


def test_decontamination(spark, sf_dir):
    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    for extra, block_words in (([], 10 ** 6), ([(900, "The of"), (901, "and"), (902, None), (903, "The OF")], 40)):
        own = bench.select("item_id", "text").unionByName(spark.createDataFrame(extra, "item_id bigint, text string"))
        found = suffix_decontam.marked(docs, own, block_words=block_words).select(
            "row.doc_id", "found.n_words", "found.n_hit", "found.items", "found.matches").collect()
        assert sorted(tuple(r)[:4] for r in found) == sorted(hits(rows, items + extra))
    texts = dict(rows)
    longest = [(r["doc_id"], m) for r in found for m in r["matches"]]
    for doc, m in longest[:200]:
        words = [w.decode() for w in suffix_decontam.words_of(texts[doc])]
        theirs = [w.decode() for w in suffix_decontam.words_of(dict(items + extra)[int(m["item"])])]
        assert words[m["word"]:m["word"] + m["length"]] == theirs[m["item_word"]:m["item_word"] + m["length"]]


def test_decontamination_of_odd_rows(spark, odd):
    bench = spark.createDataFrame([(1, "word word"), (None, None)], "item_id bigint, text string")
    found = suffix_decontam.marked(odd, bench).select("row.doc_id", "row.found", "found.n_hit").collect()
    assert sorted((r[0] or 0, r[1], r[2]) for r in found) == [
        (0, 7, 0), (1, 7, 0), (2, 7, 0), (2, 7, 0), (3, 7, 30_000), (4, 7, 0), (5, 7, 0)]
    assert suffix_decontam.clean(odd, bench.limit(0)).count() == 7
    assert suffix_decontam.clean(odd.limit(0), bench).columns == odd.columns


def encoded(path, texts, end):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return [e.ids + [end] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


TEXTS = [None, "", "a", "  a  b\n c\t d's  x", "é x́, a² 2²3 ,.", " lead <|endoftext|> x ", "Σας　 　x\x85 z",
         "word " * 3_000, "don't, won't... (yes) 'tis"]


def test_packing(spark, sf_dir):
    path = tokenizer_path("byte_bpe_50k.json")
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    rows += [(10_000 + k, t) for k, t in enumerate(TEXTS)]
    ids = dict(zip((d for d, _ in rows), encoded(path, [t for _, t in rows], 0)))
    for max_open in (1024, 5):
        pieces = packing.packed(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), path,
                                max_open=max_open).collect()
        again, sequences = defaultdict(list), defaultdict(list)
        for p in pieces:
            own = ids[p["doc_id"]]
            assert list(p["ids"]) == own[p["start"]:p["start"] + p["length"]] and p["doc_tokens"] == len(own)
            assert p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes())
            again[p["doc_id"]].append((p["start"], p["length"]))
            sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        for doc, own in ids.items():
            at = 0
            for start, length in sorted(again[doc]):
                assert start == at
                at += length
            assert at == len(own)
        for parts in sequences.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 1024
        # One padded window a partition at most.
        assert sum(sum(n for _, n in parts) < 1024 for parts in sequences.values()) <= 3


def test_sum_of_squares():
    packer = packing.Packer(10)
    rng = np.random.default_rng(1)
    for size in rng.integers(1, 10, 300):
        before = packer.levels.copy()
        level = packer._level(int(size))
        costs = {}
        for h in range(0, 10 - size + 1):
            if h == 0 or before[h]:
                after = before.copy()
                after[h] -= h > 0
                after[h + size] += h + size < 10
                costs[h] = (after ** 2).sum()
        assert costs[level] == min(costs.values())
        list(packer.add("d", np.zeros(size, np.uint32)))


def test_token_store(spark, sf_dir):
    path, store = tokenizer_path("word_bpe_49k.json"), scratch_path(spark, "t-store")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").unionByName(spark.createDataFrame(
        [(10_000 + k, t) for k, t in enumerate(TEXTS)] + [(None, "x"), (10_000, "again")], "doc_id bigint, text string"))
    token_store.write_store(docs, store, path)
    rows = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"]) for r in docs.collect() if r["text"])
    found = token_store.read_store(spark, store).orderBy("start").collect()
    names = [-1 if r["doc_id"] is None else r["doc_id"] for r in found]
    assert names == sorted(names) and len(found) == docs.count()
    at = 0
    for r in found:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r["n_tokens"]
    by_doc = defaultdict(list)
    for r in found:
        by_doc[-1 if r["doc_id"] is None else r["doc_id"]].append(list(r["ids"]))
    for (doc, _), ids in zip(rows, encoded(path, [t for _, t in rows], 1)):
        assert ids in by_doc[doc]
    assert [list(x) for x in token_store.read_document(spark, store, 10_003)] == by_doc[10_003]
    empty = scratch_path(spark, "t-store-empty")
    token_store.write_store(docs.limit(0), empty, path)
    assert token_store.read_store(spark, empty).count() == 0


def test_warc(spark):
    import hashlib
    big, other = "<p>é\r\n\r\nWARC/1.1\r\n" + "x" * 1_200, "y" * 1_000
    rows = [(1, "http://a/1", big), (2, None, big), (5, "http://a/5", big), (3, "http://a\r\n/3", "small"),
            (4, "u", "small"), (6, "u", None), (7, "u", other), (8, "u", ""), (None, "u", other)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("target", F.lit(1))
    path = scratch_path(spark, "t-warc")
    warc.write_archives(pages, path, captures_per_file=2)
    found = warc.captures(warc.read_records(spark, path)).collect()
    seen = {}
    for r in found:
        page = re.search(r"page-id: (\d*)", r["metadata"]["fields"])[1]
        seen[int(page) if page else None] = r
    for page, url, html in rows:
        r, payload = seen[page]["capture"], (html or "").encode()
        assert (r["payload_bytes"], r["digest"]) == (len(payload), hashlib.sha1(payload).hexdigest())
        assert r["kind"] == ("revisit" if page in (1, 2, None) else "response")
        assert r["kind"] == "revisit" or bytes(r["payload"]) == payload
        assert seen[page]["request"]["fields"].startswith("GET ")
    assert seen[1]["capture"]["refers_to"] == seen[2]["capture"]["refers_to"] == seen[5]["capture"]["record_id"]
    empty = scratch_path(spark, "t-warc-empty")
    warc.write_archives(pages.limit(0), empty)
    assert warc.captures(warc.read_records(spark, empty)).count() == 0


def test_html(spark, sf_dir):
    article = "".join(f"<p>Text &amp; more {k}, with words enough to read, and so on.\n Next   sentence.</p>" for k in range(4))
    page = ("<html><body><header class=top><p>Site</p></header><nav><ul><li><a href=/>Home</a></ul></nav>"
            f"<div class='cookie-notice'>We use cookies.</div><article><h1>Title</h1>{article}</article>"
            "<aside class=sidebar><h3>Related</h3><ul><li><a href=/x>Other</a></li></ul></aside>"
            "<form><p>Name</p><input></form><section id=comments><div class=comment><p>Bob</p><p>I agree, very "
            "nice indeed.</p></div></section><footer>&copy; us</footer></body></html>")
    rows = [(1, "u", page), (2, "u", None), (3, "u", ""), (4, "u", "<<<>>"), (5, "u", "<div>" * 3_000 + "deep"),
            (1, "u", page)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("own"))
    found = html_extract.extracted(pages, layouts=200).select("row.page_id", "row.text", F.col("text").alias("main"), "n_chars").collect()
    want = "\n\n".join(["Title", *[f"Text & more {k}, with words enough to read, and so on. Next sentence." for k in range(4)]])
    texts = defaultdict(list)
    for r in found:
        assert r["text"] == "own" and r["n_chars"] == len(r["main"])
        texts[r["page_id"]].append(r["main"])
    assert texts[1] == [want, want] and texts[2] == texts[3] == [""] and len(texts) == 5


def test_html_of_any_depth():
    model, depth = html_extract.trained(40), 50_000
    pages = ["<div>" * depth + "deep", "<div>" * depth + "deep" + "</div>" * depth + "<p>last</p>", "<p>flat</p>"]
    texts = html_extract.main_texts(model, pages)
    assert len(texts) == 3 and all(isinstance(t, str) for t in texts)
    for page, want in zip(pages, (["deep"], ["deep", "last"], ["flat"])):
        assert html_extract.blocks(html_extract.parsed(page), lambda node: True) == want
    page = "a<div>b<p>c<b>d</b></p>e<div></div>f</div>g<ul><li>h<li>i</ul>"
    assert html_extract.blocks(html_extract.parsed(page), lambda node: node.tag != "p") == ["a", "b", "e", "f", "g", "h", "i"]


def test_html_share_of_like_siblings():
    for times in (50, 51, 500):  # 200 siblings, 204, 2000
        nodes, x = html_extract.node_features(html_extract.parsed("<h2>a</h2><p>b</p><p>c</p><p>d</p>" * times))
        shares = {node.tag: x[node.index, 13] for node in nodes[1:]}
        assert shares == {"h2": 0.25, "p": 0.75}


def test_models_on_held_out_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    langs = QUERIES["op2_language_id"](spark, sf_dir).where("held_out").join(docs, "doc_id")
    right, n = langs.selectExpr("count_if(lang = lang_pred)", "count(*)").first()
    assert right >= 0.97 * n
    scores = QUERIES["op3_quality_gam"](spark, sf_dir).where("held_out").join(table(spark, sf_dir, "labels"), "doc_id")
    right, n = scores.selectExpr("count_if(predicted = quality)", "count(*)").first()
    assert right >= 0.9 * n


def test_language_models_keep_rare_four_grams(spark):
    """Beyond 5 million four-grams a language, those seen once or twice count as well."""
    texts = ["word " * 12_000] * 100 + ["quiz jump", "jump"]
    rows = spark.createDataFrame([("en", t) for t in texts], "lang string, text string").repartition(8)
    want = defaultdict(int)
    for text, times in (("word " * 12_000, 100), ("quiz jump", 1), ("jump", 1)):
        spelled = "\0\0\0" + "\0".join(text.split()) + "\0"
        for i in range(len(spelled) - 3):
            want[sum(ord(c) << 16 * (3 - k) for k, c in enumerate(spelled[i:i + 4]))] += times
    found = {r["gram"]: r["n"] for r in language_id.gram_counts(rows).collect()}
    assert sum(found.values()) > 5_000_000 and {1, 2} <= set(found.values())
    assert {k % 2 ** 64: n for k, n in found.items()} == want


def test_language_limits_from_all_distinct_texts(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join("".join(rng.choice(list("aeioun"), rng.integers(2, 6))) for _ in range(12)) for _ in range(400)]
    rows = [("en", t) for t in texts] + [("fr", f"{t} zyx") for t in ("xyzzy xyz", "zzyx yzx")]
    frame = spark.createDataFrame(rows, "lang string, text string")
    # The text that came first in a sample by hash has thousands of copies.
    first = frame.orderBy(F.xxhash64("lang", F.length("text"), F.substring("text", 1, 64))).where("lang = 'en'").first()
    model = language_id.fitted(frame.union(spark.createDataFrame([first] * 3_000, frame.schema)))
    bits = {t: model.judge([t])[0][2] for _, t in rows}
    assert model.langs == ["en", "fr"] and np.isfinite(model.limits).all()
    own = sorted(bits[t] for lang, t in rows if lang == "en")
    assert own[396] <= model.limits[0] <= own[398] and model.limits[1] == max(bits[t] for lang, t in rows if lang == "fr")


def test_models_on_odd_rows(spark, odd):
    found = language_id.identified(odd, F.lit(True)).select("row.doc_id", "lang_pred", "score").collect()
    assert len(found) == 7 and all(0 <= r["score"] <= 1 for r in found)
    assert {r["doc_id"] for r in found if r["lang_pred"] == "und"} == {None, 1, 4}
    assert {r[0] for r in language_id.identified(odd, F.lit(False)).select("lang_pred").collect()} == {"und"}
    labels = spark.createDataFrame([(1, 1), (99, 0), (None, 1), (2, None)], "doc_id bigint, quality int")
    for chosen in (labels, labels.limit(0)):
        rows = quality_gam.scored(odd, chosen, F.lit(True)).select("row.score", F.col("score").alias("s")).collect()
        assert len(rows) == 7 and all(r["score"] == 7 and 0 <= r["s"] <= 1 for r in rows)


def test_native_operators_on_odd_rows(spark, odd):
    judged = divergence.judged(odd).select("row.doc_id", "base_failed", "n_words", "kept").collect()
    assert sorted((r[0] or 0, r[2]) for r in judged) == [(0, 0), (1, 0), (2, 1), (2, 1), (3, 30_000), (4, 0), (5, 3)]
    assert all(r["base_failed"] and not r["kept"] for r in judged)
    assert divergence.keep(odd).columns == odd.columns and divergence.keep(odd.limit(0)).count() == 0
    lines = line_dedup.cleaned(odd, min_pages=2, max_ratio=0.9).select("row.doc_id", "row.host", "text").collect()
    assert len(lines) == 7 and all(r["host"] == 7 for r in lines)
    assert {r["text"] for r in lines if r["doc_id"] is None} == {None}
    assert line_dedup.cleaned(odd.limit(0)).count() == 0


def test_line_dedup_of_a_large_group_of_copies(spark):
    """A third of a host's pages are copies: their lines stay in the pipeline, the menu goes."""
    copy = "Home\n" + "\n".join(f"the {k}. line of a page with many copies" for k in range(9))
    rows = [(k, copy if k % 3 == 0 else f"Home\nfirst of {k}\nsecond of {k}", "s", 1) for k in range(90)]
    rows += [(100 + k, None, "s", 0) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars int").repartition(4)
    found = corpus_pipeline.without_boilerplate(spark, docs, "").collect()
    want = {d: text and text.removeprefix("Home\n") for d, text, *_ in rows}
    assert len(found) == len(rows) and {r["doc_id"]: r["text"] for r in found} == want
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in found)
    # As in the SQL, the operator by itself counts rows.
    assert {r["text"] for r in line_dedup.cleaned(docs).where("row.doc_id % 3 = 0 AND row.doc_id < 90").collect()} == {""}


def test_pipeline(spark, sf_dir):
    """Kept documents and their ids, each stage redone by other means."""
    duck = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        duck.execute(f"CREATE TABLE {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    kept = duck.execute(f"SELECT doc_id FROM ({ORACLE['op4_divergence']}) WHERE kept").df()  # noqa: F841
    duck.execute("CREATE TABLE good AS SELECT * FROM documents WHERE doc_id IN (SELECT doc_id FROM kept)")
    rows = duck.execute(ORACLE["op6_line_dedup"].replace("FROM documents", "FROM good")).fetchall()
    rows = [(r[0], r[1]) for r in rows]
    groups = components_of(rows)
    rows = [r for r in rows if groups[r[0]][1] == r[0]]
    items = duck.execute("SELECT item_id, text FROM benchmark").fetchall()
    bad = {d for d, n, hit, _ in hits(rows, items) if hit and 20 * hit >= n}
    rows = [r for r in rows if r[0] not in bad]
    ids = dict(zip((d for d, _ in rows), encoded(tokenizer_path("byte_bpe_50k.json"), [t for _, t in rows], 0)))
    found = defaultdict(list)
    for p in corpus_pipeline.run(spark, sf_dir).orderBy("doc_id", "start").collect():
        found[p["doc_id"]] += p["ids"]
    assert found == ids
