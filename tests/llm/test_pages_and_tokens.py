"""The page parser on real and malformed pages; word-by-word encoding against the library."""

import html
import re
import time

import duckdb
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from gaugeline.llm.dom import parsed
from gaugeline.llm.queries import QUERIES, tokenizer_path
from gaugeline.llm.tokens import PieceEncoder, runs

N = 1_000_000
SHAPES = {
    "open tags": "<a " * (N // 3), "div and b": "<div>" * (N // 11) + "</b>" * (N // 11),
    "quotes": '<a "x>" ' * (N // 8) + "'", "names": "<a" * (N // 2) + ' " >',
    "inline before blocks": "<i>" * (N // 8) + "<div></div>" * (N // 20),
    "end tags behind a table": "<div><table>" + "<i>" * (N // 8) + "</div>" * (N // 12),
    "script without end": "<script>" + "</script " * (N // 9), "list items": "<li>" * (N // 4),
    "attributes": "<a " + 'class="' * (N // 7) + ">", "two quotes": "<a '\"" * (N // 5) + ">",
    "cells": "<table>" + "<td>" * (N // 4), "comments": "<!--" * (N // 4), "end tags": "</div " * (N // 6),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_malformed_pages_take_time_in_proportion(shape):
    start = time.process_time()
    parsed(SHAPES[shape])
    # A second or two here; a parser that looks twice needs minutes.
    assert time.process_time() - start < 20


def outline(node):
    return [node.tag, *[p if isinstance(p, str) else outline(p) for p in node.parts]]


@pytest.mark.parametrize("page, tree", [
    ("<p>a<p>b</i>c", ["html", ["p", "a"], ["p", "b", "c"]]),
    ("<table><tr><td>a<td>b<div></table></div>x", ["html", ["table", ["tr", ["td", "a"], ["td", "b", ["div"]]]], "x"]),
    ("<article><p>a<br></article><footer>f</footer>", ["html", ["article", ["p", "a", "\n"]], ["footer", "f"]]),
    ("<ul><li>a<ul><li>b</ul><li>c</ul>", ["html", ["ul", ["li", "a", ["ul", ["li", "b"]]], ["li", "c"]]]),
    ("a < b <a title='x>y'>c</a> <1> <b", ["html", "a < b ", "c", " <1> <b"]),
    ("<!-->x--><![CDATA[t]]><?p ?><script>a</script x>b", ["html", "t", "b"]),
    ("<div><table></div>a</table></div>b", ["html", ["div", ["table", "a"]], "b"]),
])
def test_trees(page, tree):
    assert outline(parsed(page)) == tree


def test_every_paragraph_of_an_article_is_found_and_nothing_else(spark, sf_dir):
    pages = dict(duckdb.sql(f"SELECT page_id, html FROM '{sf_dir}/pages.parquet'").fetchall())
    found = {r["page_id"]: r["text"] for r in QUERIES["op9_html_extract"](spark, sf_dir).collect()}
    assert set(found) == set(pages)
    plain = lambda mark_up: re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", "", mark_up))).strip()
    paragraphs = 0
    for page_id, page in pages.items():
        article = re.search(r"<article.*?</article>", page or "", re.DOTALL)
        if not article:
            continue
        for text in re.findall(r"<p>(.*?)(?=</p>|<p>|</article>|<div|<ul|<h)", article[0], re.DOTALL):
            paragraphs += 1
            assert plain(text) in found[page_id]
        whole = plain(article[0]).replace(" ", "")
        for block in found[page_id].split("\n\n"):
            assert re.sub(r"\s", "", block) in whole
    assert paragraphs > 100


ODD = [None, "", " ", "  a", " a  b", "\n x", "a  b", "x , y, (z).", "é, É.   q", "don't, stop!! a1, b_2. 3, ½, x½,",
       "\x1c a", "a\x85 b", "\0 a \0b, ,", "a ,", "ﬁ, ß. İ, Ǆ.", "<|endoftext|> x", "a,b c,d,e f..", "　 a", "a" * 5000]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("limit", [48_000_000, 2_000])
def test_pieces_give_the_ids_of_whole_texts(sf_dir, name, limit):
    texts = [t for t, in duckdb.sql(f"SELECT text FROM '{sf_dir}/documents.parquet' ORDER BY doc_id").fetchall()]
    library = Tokenizer.from_file(tokenizer_path(name))
    library.encode_special_tokens = True
    own = PieceEncoder(tokenizer_path(name), limit)
    for rows in (ODD, texts, ODD):
        column = pa.array(rows, pa.string())
        for start, stop in runs(column, 50_000):
            ids, lengths = own.encode(column.slice(start, stop - start))
            expected = [e.ids for e in library.encode_batch([t or "" for t in rows[start:stop]], add_special_tokens=False)]
            assert lengths.tolist() == list(map(len, expected))
            assert ids.tolist() == [i for e in expected for i in e]
