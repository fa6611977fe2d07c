"""The other operators of the subpackage: brute force, round trips, fixtures, held-out accuracy."""

import gzip
import hashlib
import html
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from echoloom.llm import bpe, contamination, cotraining, license_scan, page_text, permutation_index, url_reputation, warc
from echoloom.llm.queries import QUERIES, URL_RULES

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


# -- nearest neighbours ----------------------------------------------------------------------------


def brute_nearest(rows, k):
    good = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for q, a in good:
        if q % 100 == 0:
            near = sorted((float(np.sqrt(sum((a - b) ** 2))), i) for i, b in good if i != q)[:k]
            out += [(q, n + 1, i) for n, (_, i) in enumerate(near)]
    return sorted(out)


def test_nearest_is_exact_on_tiny_tables_and_skips_bad_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(30)]
    rows += [(100, [float(x) for x in rng.normal(size=6)]), (300, rows[7][1]), (301, rows[7][1]), (400, None), (500, [0.0] * 6), (600, [float("nan")] + [1.0] * 5), (700, [None] + [1.0] * 5), (None, [1.0] * 6), (800, [float("inf")] * 6), (900, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    out = permutation_index.nearest(df, F.col("vec_id") % 100 == 0)
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in out.collect()) == brute_nearest([r for r in rows if r[1] != []], 10)
    few = permutation_index.nearest(df.where("vec_id in (0, 1, 2)"), F.col("vec_id") % 100 == 0).collect()
    assert len(few) == 2
    assert permutation_index.nearest(df.where("vec_id < 0"), F.col("vec_id") % 100 == 0).collect() == []


def test_repeated_rows_copies_and_lengths(spark):
    rng = np.random.default_rng(2)
    vectors = [[float(x) for x in rng.normal(size=4)] for _ in range(5)]
    # One id with two vectors, whole repeats, 30 copies of one vector, another length, and signed zeros.
    rows = [(0, vectors[0]), (1, vectors[1]), (1, vectors[2]), (1, vectors[1]), (100, vectors[3]), (100, vectors[3])]
    rows += [(10 + i, vectors[0]) for i in range(30)] + [(200, [1.0, 2.0]), (201, [1.0, 2.5]), (300, [1.0, 0.0, 0.0, 0.0]), (301, [1.0, -0.0, 0.0, 0.0])]
    out = permutation_index.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 100 == 0).collect()
    expected = []
    for q in (0, 100, 200, 300):
        own = min(v for i, v in rows if i == q)
        near = {}
        for i, v in rows:
            if i != q and len(v) == len(own):
                far = float(np.sqrt(sum((a - b) ** 2 for a, b in zip(own, v))))
                near[i] = min(far, near.get(i, far))
        expected += [(q, n + 1, i) for n, (_, i) in enumerate(sorted((d, i) for i, d in near.items())[:10])]
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in out) == sorted(expected)


def measured_share(x, rows, k=10):
    """How much of a block is measured again, and the recall of it, at the shipped setting."""
    ids, pivots = np.arange(len(x)), x[np.random.default_rng(5).permutation(len(x))[: permutation_index.PIVOTS]]
    blocks = [permutation_index.Block(part, x[part], pivots, permutation_index.RANKED) for part in np.array_split(ids, -(-len(x) // rows))]
    asked = ids[:: max(1, len(x) // 60)]
    right = seen = 0
    for q, order in zip(asked, permutation_index.ranking(x[asked], pivots, permutation_index.RANKED)):
        seen += sum(len(b.candidates(order, k, permutation_index.SHARE)) for b in blocks)
        found = [b.search(x[q], order, q, k) for b in blocks]
        near = np.concatenate([f[0] for f in found])[np.argsort(np.concatenate([f[1] for f in found]), kind="stable")[:k]]
        far = ((x - x[q]) ** 2).sum(axis=1)
        far[q] = np.inf
        right += len(set(near.tolist()) & set(np.argsort(far, kind="stable")[:k].tolist()))
    return seen / len(x) / len(asked), right / k / len(asked)


@pytest.mark.parametrize("count", [500, 2000, 10_000, 50_000])
def test_recall_at_the_shipped_share(count):
    rng = np.random.default_rng(count)
    x = rng.normal(size=(max(4, count // 50), 64))[rng.integers(0, max(4, count // 50), count)] + 1.5 * rng.normal(size=(count, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    share, recall = measured_share(x, 10_000)
    # Measuring everything would be found out by the share, ranking by anything else by the recall.
    assert share <= permutation_index.SHARE + 0.01 and recall >= 0.9


def test_the_footrule_ranks_the_candidates(monkeypatch):
    x = np.random.default_rng(7).normal(size=(2000, 16))
    good = measured_share(x, 10_000)[1]
    monkeypatch.setattr(permutation_index.Block, "footrule", lambda self, order: np.zeros(len(self.vectors), np.int32))
    assert good >= 0.9 and measured_share(x, 10_000)[1] < 0.4


def test_recall_of_the_query(spark, small):
    for folder, answers in (("0.01", 50), ("0.1", 200)):
        rows = spark.read.parquet(small.replace("0.001", folder) + "/embeddings.parquet")
        found = {(r.query_id, r.vec_id) for r in permutation_index.nearest(rows, F.col("vec_id") % 100 == 0).collect()}
        brute = {(q, i) for q, _, i in brute_nearest([(r.vec_id, r.embedding) for r in rows.collect()], 10)}
        assert len(brute) == answers and len(brute & found) >= 0.9 * answers


def test_footrule_from_files_equals_its_definition():
    rng = np.random.default_rng(3)
    x, pivots = rng.normal(size=(50, 4)), rng.normal(size=(12, 4))
    block = permutation_index.Block(np.arange(50), x, pivots, 5)
    orders = permutation_index.ranking(block.vectors, pivots, 5)
    place = np.full((50, 12), 5)
    np.put_along_axis(place, orders, np.arange(5)[None, :].repeat(50, 0), 1)
    for q in range(50):
        assert (block.footrule(orders[q]) == np.abs(place - place[q]).sum(axis=1)).all()


# -- byte pair encoding ----------------------------------------------------------------------------


def samples():
    rng = random.Random(4)
    parts = ["a", "b", "th", "e", " ", "  ", "\n", "é", "漢", "字", "😀", "ing", "tion", "0", "12", "!!", "\u0301", "ß", "я", "привет", "'s", "\u00a0", "\x1f", "\t"]
    out = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(400)]
    return out + ["", " ", "a" * 3000, "ab" * 900, "漢字" * 300, " " * 500, "x" * 97, "word " * 50, "<|endoftext|> text"]


def test_encoding_equals_the_library(reference):
    own = bpe.PrefixBpe(bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    for text in samples():
        ids = own.encode(text)
        assert ids == reference.encode_ordinary(text), text
        assert own.decode(ids) == text.encode()
    pieces = [p.encode() for t in samples() for p in own.pattern.findall(t)]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode_pieces(pieces)] == [own.encode_piece(p) for p in pieces]


def test_appends_and_edits_equal_encoding_afresh():
    own = bpe.PrefixBpe(bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    rng = random.Random(6)
    table = bpe.PrefixTable(own)
    for _ in range(60):
        piece = bytes(rng.choice(b"theraionsdg") for _ in range(rng.randrange(1, 6)))
        if rng.random() < 0.5 or not table.piece:
            table.append(piece)
        else:
            a = rng.randrange(len(table.piece))
            table.replace(a, min(len(table.piece), a + 2), piece)
        assert table.tokens() == own.encode_piece(table.piece)


def test_encoding_query(spark, small, reference):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    out = QUERIES["op2_prefix_bpe"](spark, small).collect()
    assert len(out) == len(docs)
    for r in out:
        ids = reference.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_encoding_of_nulls_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, 3), (None, "a", 4), (1, None, 3)], "doc_id long, text string, n_tokens int")
    out = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256[:8]) for r in bpe.encode_documents(df, RANKS, public_tokenizers.PATTERN).collect())
    assert out == [("1", 0, "e3b0c442"), ("1", 0, "e3b0c442"), ("None", 1, out[2][2])]
    assert bpe.encode_documents(df.where("doc_id = 9"), RANKS, public_tokenizers.PATTERN).collect() == []


# -- decontamination -------------------------------------------------------------------------------


def grams(text, size=5):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    n = min(size, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set(), n


def holds(doc, item):
    own, width = grams(item)
    words = re.findall(rb"[^\x20\x09-\x0D]+", (doc or "").encode().lower())
    there = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
    return bool(own) and 100 * len(own & there) >= 80 * len(own)


def test_contained_items_equal_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 4, 5, 6, 12, 40])))) for i in range(40)] + [(90, None), (91, ""), (92, " \n"), (93, "W1")]
    docs = []
    for i in range(120):
        text = [rng.choice(words) for _ in range(rng.choice([0, 3, 30, 300]))]
        for _ in range(rng.choice([0, 1, 2])):
            own = (rng.choice(items)[1] or "").split()
            if own and rng.random() < 0.5:
                own[rng.randrange(len(own))] = "changed"
            at = rng.randrange(len(text) + 1)
            text[at:at] = [w.upper() for w in own]
        docs.append((i, "\n ".join(text)))
    docs += [(500, None), (501, ""), (3, docs[3][1])]
    expected = sorted((d, i) for d, t in docs for i, x in items if holds(t, x))
    a = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    b = spark.createDataFrame(items, "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in contamination.contained_items(a, b).collect()) == expected
    monkeypatch.setattr(contamination, "GROUP_BYTES", 400)
    assert sorted((r.doc_id, r.item_id) for r in contamination.contained_items(a, b).collect()) == expected
    bad = {d for d, _ in expected}
    clean = contamination.without_items(a, b)
    assert clean.columns == a.columns and sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(d) for d, _ in docs if d not in bad)
    assert contamination.contained_items(a, b.where("item_id < 0")).collect() == []


# -- pages -----------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div><aside>side</aside>
<article><header><h1>Title &amp; more</h1></header><p>First&nbsp;one
 goes <b>on</b><br>here &lt;x&gt;<p>Second, a < b</p><div class="ad">buy</div><form><p>mail</p><input value=">"></form><ul><li>one<li>two</ul><!-- <p>no</p> -->
<p style="display:none">hidden</p></article><section id="comments"><p>reader</p></section><footer>&copy; us</footer></body></html>"""


def test_page_fixture(spark):
    rows = [(1, "http://a.example.com/x/1", PAGE), (2, None, None), (3, "bad", ""), (4, "http://b.example.com/", "plain &am text"), (1, "http://a.example.com/x/1", PAGE)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    out = {r.page_id: r for r in page_text.extract(df).collect()}
    assert out[1].text == "Title & more\n\nFirst one goes on here <x>\n\nSecond, a < b\n\none\n\ntwo" and out[1].n_chars == len(out[1].text)
    assert out[2].text == "" and out[3].text == "" and out[4].text == "plain &am text"
    assert page_text.extract(df).count() == 5 and page_text.extract(df.where("page_id = 9")).collect() == []


def test_lines_shared_with_the_next_page_go(spark):
    def page(body):
        return f"<body><div>Welcome to us</div><p>{body}</p><div>All rights kept</div></body>"

    rows = [(i, f"https://www.one.example.org/en/{i}", page(f"own text {i}")) for i in range(700)] + [(900, "https://alone.example.org/1", page("alone"))]
    out = {r.page_id: r.text for r in page_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out == {**{i: f"own text {i}" for i in range(700)}, 900: "Welcome to us\n\nalone\n\nAll rights kept"}


def test_near_copies_of_an_article_keep_their_text(spark):
    body = "<body><nav>menu</nav><article><h1>Same</h1><p>shared</p><p>{}</p></article></body>"
    rows = [(i, f"http://h.example.com/{i}", body.format(i)) for i in range(3)]
    out = {r.page_id: r.text for r in page_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out == {i: f"Same\n\nshared\n\n{i}" for i in range(3)}


def test_common_lines_are_a_longest_common_subsequence():
    rng = random.Random(2)

    def longest(a, b):
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
        return table[-1][-1]

    for _ in range(300):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(12))] for _ in range(2))
        left, right = page_text.common_lines(a, b)
        assert left == sorted(set(left)) and right == sorted(set(right)) and [a[i] for i in left] == [b[j] for j in right] and len(left) == longest(a, b)


def test_page_query_takes_the_articles(spark, small):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    for r in QUERIES["op4_page_differencing"](spark, small).collect():
        body = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n\n".join(x for x in blocks if x) and r.n_chars == len(r.text)


# -- licences --------------------------------------------------------------------------------------


def test_licenses_are_found_whole_and_changed(spark):
    filler = " ".join(f"filler{i}" for i in range(300))
    apache = license_scan.TEMPLATES["Apache-2.0-notice"]
    docs = [(1, filler + "\n" + license_scan.TEMPLATES["MIT"].upper() + "\n" + filler), (2, apache.replace("distributed", "handed out").replace("compliance", "line")), (3, filler), (4, None), (5, ""),
            (6, "Released under the MIT License. Some words. Released under the MIT License."), (7, "the MIT the License the under"), (8, license_scan.TEMPLATES["GPL-2.0"])]
    out = license_scan.scan_documents(spark.createDataFrame(docs, "doc_id long, text string").withColumn("license", F.lit("clash"))).collect()
    found = sorted((r.doc_id, r.license) for r in out)
    assert found == [(1, "MIT"), (2, "Apache-2.0-notice"), (6, "MIT"), (6, "MIT"), (8, "GPL-2.0")]
    hit = next(r for r in out if r.doc_id == 1)
    assert docs[0][1].encode()[hit.start_byte : hit.end_byte].decode() == "RELEASED UNDER THE MIT LICENSE" and hit.coverage == 1.0


def test_each_notice_is_named_rightly():
    scanner = license_scan.Scanner(license_scan.TEMPLATES)
    for name, text in license_scan.TEMPLATES.items():
        found = scanner.scan([("before it " + text + " and after it").encode()])
        assert [f[1] for f in found] == [name], (name, found)
    for text in ("Released under the Foo License.", "Licensed under CC BX 4.0.", "This work is licensed under the GNU General Public License, version 4.", license_scan._gnu("Affero ", "program", "4")):
        assert scanner.scan([text.encode()]) == []


def brute_licenses(text, percent=license_scan.COVERAGE):
    """By longest common subsequence over every window: the licences that no better one lies across."""

    def words(x):
        return re.sub(rb"[^0-9a-z\x80-\xff]+", b" ", x.encode().lower()).split()

    def aligned(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b):
                last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
        return row[-1]

    own, finds = words(text), []
    for name, template in license_scan.TEMPLATES.items():
        there = words(template)
        width = max(len(there), int(np.ceil(len(there) * license_scan.SPAN)))
        needed = set(words(license_scan.needed_words(name))) & set(there)
        best = max(((aligned(own[i : i + width], there), -i) for i in range(len(own)) if own[i] in there and needed <= set(own[i : i + width])), default=(0, 0))
        if 100 * best[0] >= percent * len(there):
            finds.append((best[0], best[0] / len(there), name))
    return max(finds)[2] if finds else None


def test_scan_equals_brute_force(spark):
    rng = random.Random(12)
    docs = []
    for i, name in enumerate(["MIT-notice", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-notice", "LGPL-3.0-notice", "MPL-2.0", "CC0-1.0", "Zlib", "ISC", "EPL-2.0", "Unlicense", "Apache-2.0-notice"]):
        own = license_scan.TEMPLATES[name].split()
        for share in (0.0, 0.05, 0.4):
            words = [w if rng.random() >= share else "changed" for w in own]
            docs.append((len(docs), " ".join([*(f"w{k}" for k in range(30)), *words, *(f"v{k}" for k in range(30))])))
    table = spark.createDataFrame(docs + [docs[0], (None, docs[3][1]), (900, ("long word " * 300_000) + license_scan.TEMPLATES["MIT"])], "doc_id long, text string")
    out = license_scan.scan_documents(table).collect()
    found = {r.doc_id: r.license for r in out if r.doc_id is not None and r.doc_id < 900}
    expected = {i: name for i, text in docs if (name := brute_licenses(text))}
    assert len(expected) >= 20 and found == expected
    assert sum(r.doc_id == 0 for r in out) == 2 and sum(r.doc_id is None for r in out) == 1 and [r.license for r in out if r.doc_id == 900] == ["MIT"]
    assert license_scan.scan_documents(table.where("doc_id = -1")).collect() == []


def test_every_planted_license_line_is_found(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    planted = {r.doc_id for r in docs if re.search(r"Released under the MIT License|under the GNU General Public License, version|Licensed under the Apache License, Version|Licensed under CC BY-NC", r.text)}
    assert {r.doc_id for r in QUERIES["op5_license_scan"](spark, small).collect()} == planted


def test_patience_keeps_order():
    a, b = "x a b c d y".split(), "a q b d c".split()
    pairs = license_scan.patience(a, b)
    assert all(a[i] == b[j] for i, j in pairs) and pairs == sorted(pairs) and [j for _, j in pairs] == sorted(j for _, j in pairs) and len(pairs) == 3
    assert license_scan.rising([3, 1, 2, 5, 4]) in ([1, 2, 4], [1, 2, 3])


# -- WARC ------------------------------------------------------------------------------------------


def test_warc_round_trip_and_links(spark, tmp_path):
    source = warc.response_of_page(7, "http://a.example.com/", "<title>T &amp; t</title><p>Hello<p><a href='/x'>there</a><script>no()</script>")
    metadata, conversion, links = warc.derive(source)
    assert links == 1 and conversion.block == b"Hello\nthere" and conversion.get("WARC-Refers-To") == metadata.get("WARC-Refers-To") == source.get("WARC-Record-ID")
    assert conversion.get("WARC-Refers-To-Payload-Digest") == source.get("WARC-Payload-Digest") and conversion.get("WARC-Block-Digest") == warc.digest(conversion.block)
    assert b'"Title": "T & t"' in metadata.block and metadata.get("WARC-Record-ID") != conversion.get("WARC-Record-ID")
    data = b"".join(gzip.compress(warc.write_record(r)) for r in (source, metadata, conversion))
    again = list(warc.read_records(data))
    assert [r.block for r in again] == [source.block, metadata.block, conversion.block] and again[2].get("WARC-Refers-To") == conversion.get("WARC-Refers-To")
    assert len(list(warc.read_records(warc.write_record(source)[:-40]))) == 0
    (tmp_path / "a.warc.gz").write_bytes(data)
    records = warc.read_warc(spark, str(tmp_path))
    derived = warc.derivatives_of_records(records).collect()
    assert records.count() == 3 and {(r.record_type, r.refers_to) for r in derived} == {("metadata", source.get("WARC-Record-ID")), ("conversion", source.get("WARC-Record-ID"))}


def test_warc_of_nulls_repeats_and_clashes(spark):
    long_page = "<p>" + "word " * 400_000
    df = spark.createDataFrame([(None, None, None, "c"), (1, "u\r\nX: y", "", "c"), (2, "v", "z", "c"), (2, "v", "z", "c"), (3, "w", long_page, "c")], "page_id long, url string, html string, block string")
    out = warc.derivatives_of_pages(df).collect()
    assert len(out) == 10 and sorted(r.content_length for r in out if r.record_type == "conversion") == [0, 0, 1, 1, len(long_page.strip()) - 3]
    assert len({r.record_id for r in out}) == 8
    record = warc.response_of_page(1, "u\r\nX: y", "z")
    assert next(warc.read_records(warc.write_record(record))).get("X") is None
    assert warc.derivatives_of_pages(df.where("page_id = 5")).collect() == []


def response(head, body):
    block = b"HTTP/1.1 200 OK\r\n" + head + b"\r\n\r\n" + body
    return warc.Record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:1>"), ("WARC-Concurrent-To", "a"), ("WARC-Concurrent-To", "b")], block)


def test_payloads_are_unpacked_and_headers_kept():
    import json
    import zlib

    page = "<title>Été</title><p>naïve €</p>"
    chunked = b"".join(b"%x\r\n%s\r\n" % (len(x), x) for x in (page.encode()[:9], page.encode()[9:])) + b"0\r\n\r\n"
    cases = [
        (b"Content-Type: text/html; charset=ISO-8859-1", page.encode("cp1252")), (b"Content-Type: text/html", page.encode("cp1252")), (b"Content-Type: text/html", page.encode()),
        (b"A: b", b'<meta charset="windows-1252">' + page.encode("cp1252")), (b"A: b", b"\xff\xfe" + page.encode("utf-16-le")), (b"Transfer-Encoding: chunked", chunked),
        (b"Content-Encoding: gzip", gzip.compress(page.encode())), (b"Content-Encoding: deflate", zlib.compress(page.encode())), (b"Content-Encoding: gzip", page.encode()),
        (b"Content-Type: text/html; charset=nonsense", page.encode()),
    ]
    for head, body in cases:
        metadata, conversion, _ = warc.derive(response(head, body))
        assert conversion.block.decode() == "naïve €", (head, body)
        envelope = json.loads(metadata.block)["Envelope"]
        found = envelope["Payload-Metadata"]["HTTP-Response-Metadata"]
        assert found["HTML-Metadata"]["Head"]["Title"] == "Été" and found["Entity-Digest"] == warc.digest(body)
        assert envelope["WARC-Header-Metadata"]["WARC-Concurrent-To"] == ["a", "b"]
    metadata = warc.derive(response(b"Set-Cookie: a=1\r\nSet-Cookie: b=2\r\nServer: s", b""))[0]
    assert json.loads(metadata.block)["Envelope"]["Payload-Metadata"]["HTTP-Response-Metadata"]["Headers"] == {"Set-Cookie": ["a=1", "b=2"], "Server": "s"}


def test_broken_records_are_passed_over_and_counted(spark, tmp_path):
    good = [warc.response_of_page(i, f"http://a.example.com/{i}", f"<p>page {i}" * 50) for i in range(5)]
    plain = [warc.write_record(r) for r in good]
    cases = {
        "junk.warc": (plain[0] + b"junk\r\nmore junk\r\n" + plain[1] + plain[2], [0, 1, 2], 1),
        "cut.warc": (plain[0] + plain[1][:-90] + plain[2] + plain[3], [0, 2, 3], 1),
        "end.warc": (plain[0] + plain[1][:-90], [0], 1),
        "length.warc": (plain[0] + plain[1].replace(b"Content-Length: ", b"Content-Length: x", 1) + plain[2], [0, 2], 1),
        "whole.warc": (b"".join(plain), [0, 1, 2, 3, 4], 0),
        "whole.warc.gz": (b"".join(map(gzip.compress, plain)), [0, 1, 2, 3, 4], 0),
        "one.warc.gz": (gzip.compress(b"".join(plain)), [0, 1, 2, 3, 4], 0),
        "hole.warc.gz": (gzip.compress(plain[0]) + b"\x00" * 9 + gzip.compress(plain[1]), [0, 1], None),
    }
    damaged = bytearray(gzip.compress(plain[1]))
    damaged[20:60] = b"\xff" * 40
    cases["bad.warc.gz"] = (gzip.compress(plain[0]) + bytes(damaged) + gzip.compress(plain[2]), [0, 2], None)
    for name, (data, expected, broken) in cases.items():
        records = warc.Records(data)
        got = [r.get("WARC-Target-URI") for r in records]
        assert got == [good[i].get("WARC-Target-URI") for i in expected], name
        assert records.broken >= 1 if broken is None else records.broken == broken, (name, records.broken)
        (tmp_path / name).write_bytes(data)
    rows = warc.read_warc(spark, str(tmp_path)).collect()
    assert sum(r.record_type == "response" for r in rows) == sum(len(e) for _, e, _ in cases.values())
    assert {r.path.rsplit("/", 1)[1] for r in rows if r.record_type == "unreadable"} == {n for n, (_, _, b) in cases.items() if b != 0}
    assert {r.block for r in rows if r.record_type == "response"} == {r.block for r in good}


def test_derivatives_query_equals_a_second_reading(spark, small):
    """Identifiers, digests, lengths, links and titles by the standard library's own parser."""
    import base64
    import json
    import uuid
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.links, self.title, self.inside = 0, "", False

        def handle_starttag(self, tag, attrs):
            self.inside = tag == "title"
            wanted = {"a": "href", "area": "href", "link": "href", "img": "src", "script": "src", "iframe": "src", "form": "action"}
            self.links += tag in wanted and any(k in ("href", "src", "action") for k, _ in attrs)

        def handle_endtag(self, tag):
            self.inside = False

        def handle_data(self, data):
            self.title += data if self.inside else ""

    def sha1(data):
        return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()

    out = {(r.page_id, r.record_type): r for r in QUERIES["op7_warc_derivatives"](spark, small).collect()}
    pages = spark.read.parquet(f"{small}/pages.parquet").collect()
    assert len(out) == 2 * len(pages)
    for p in pages:
        reader = Reader()
        reader.feed(p.html)
        payload = p.html.encode()
        own = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(31).join((str(p.page_id), p.url, sha1(payload))))}>"
        for kind in ("metadata", "conversion"):
            r = out[p.page_id, kind]
            assert r.refers_to == own and r.target_uri == p.url and r.source_payload_digest == sha1(payload) and r.n_links == reader.links
            assert r.record_id == f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, own + chr(31) + kind)}>"
            assert r.content_length == len(r.block.encode()) and r.block_digest == sha1(r.block.encode())
        head = json.loads(out[p.page_id, "metadata"].block)["Envelope"]["Payload-Metadata"]["HTTP-Response-Metadata"]["HTML-Metadata"]["Head"]
        assert head["Title"] == " ".join(reader.title.split())
        body = re.search(r"<article>(.*?)(</article>|$)", p.html, re.S)[1]
        for words in re.findall(r">([^<]+)<", body):
            assert " ".join(html.unescape(words).split()) in " ".join(out[p.page_id, "conversion"].block.split())


# -- quality ---------------------------------------------------------------------------------------


def test_quality_on_held_out_labels(spark, small):
    folder = small.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    seen, held = labels.where("doc_id % 3 <> 0"), {r.doc_id: r.quality for r in labels.where("doc_id % 3 = 0").collect()}
    known = cotraining.features(docs)
    model = cotraining.fit(known, seen)
    out = {r.doc_id: r.kept for r in cotraining.score(known, model).collect()}
    good, bad = ([out[d] for d, q in held.items() if q == k] for k in (1, 0))
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.1 * len(bad)
    # What a view is told by the other is told by all documents: the sums count them whole.
    sums = cotraining._handed_over(known, model)
    x = np.frombuffer(b"".join(r.x for r in known.collect()), dtype="<f4").reshape(-1, cotraining.WIDTH)
    sure = [cotraining.sigmoid(m) for m in model.calibrated(model.standard(x))]
    assert [int(sums.parts(v, 1)[2][0]) for v in (0, 1)] == [int((sure[1 - v] >= cotraining.SURE).sum()) for v in (0, 1)]
    # The views share no column of the table: a text changes one, the metadata the other.
    a = cotraining.text_features([b"one text", b"another text of more words"])
    assert a.shape[1] + cotraining.meta_features([("en", "s", 5)]).shape[1] == cotraining.WIDTH


def test_pseudo_labels_teach_the_other_view():
    """The metadata view has no labelled row that tells its slots apart; the text view tells it."""
    rng = np.random.default_rng(8)
    x = np.zeros((600, cotraining.WIDTH))
    y = (np.arange(600) % 2).astype(float)
    x[:, 0] = np.where(y == 1, 1.0, -1.0) + rng.normal(0, 0.1, 600)
    labelled = np.arange(600) < 60
    at = cotraining.TEXT_WIDTH + 5
    x[~labelled, at] = y[~labelled]
    pool = x[~labelled]

    def handed(model):
        sums = cotraining.Sums()
        sums.add(model, pool)
        return sums

    alone = cotraining.co_train(x[labelled], y[labelled], lambda model: cotraining.Sums())
    told = cotraining.co_train(x[labelled], y[labelled], handed)
    assert abs(alone.betas[1][5]) < 1e-9 and told.betas[1][5] > 0.5


def test_quality_without_labels_or_rows(spark):
    kind = "doc_id long, text string, lang string, source string, quality_score double, n_chars string, x int"
    docs = spark.createDataFrame([(1, "a text", "en", "s", 1.5, "6", 1), (None, None, None, None, None, None, None), (1, "", None, "s", 2.0, "many", 2), (2, "word " * 300_000, "en", "s", 0.0, "-1", 3)], kind)
    none = spark.createDataFrame([], "doc_id long, quality int")
    known = cotraining.features(docs)
    model = cotraining.fit(known, none)
    assert sorted(str(r.doc_id) for r in cotraining.score(known, model).where("kept and quality_score = 0.5").collect()) == ["1", "1", "2", "None"]
    kept = cotraining.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes and sorted(kept.collect(), key=str) == sorted(docs.collect(), key=str)
    odd = spark.createDataFrame([(1, None), (None, 1), (1, 1), (1, 0), (2, 7)], "doc_id long, quality int")
    assert cotraining.score(known, cotraining.fit(known, odd)).count() == 4 and cotraining.score(known.where("doc_id = 7"), model).collect() == []
    assert cotraining.score(cotraining.features(docs.select("doc_id", "text")), model).count() == 4
    empty = cotraining.features(docs.where("doc_id = 9"))
    assert cotraining.score(empty, cotraining.fit(empty, odd)).collect() == [] and cotraining.keep_good(docs.where("doc_id = 9"), model).collect() == []
    # Of rows with one id and different texts, the same one is fitted wherever it stands.
    many = spark.createDataFrame([(i // 2, f"text {i} " * (i % 7 + 1), "en", "s", 0.0, "1", i) for i in range(60)], kind)
    marks = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    one, two = (cotraining.fit(cotraining.features(d), marks) for d in (many, many.orderBy(F.desc("x"))))
    assert np.allclose(one.betas[0], two.betas[0])


# -- urls ------------------------------------------------------------------------------------------


def test_rules_hosts_and_paths(spark):
    urls = ["http://A.Example.COM/en/712?x", "http://example.com/en/8", "https://other.com/en/7", "http://badexample.com/en/7", "x://net/de/", "ftp://m.example.net/de/81#t", "http://a.org/es/?q=/", "http://a.org?es/", "no scheme", None, "http://b.com/EN/1", "https://é.example.net/fr/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("verdict", F.lit("clash"))
    none = spark.createDataFrame([], "item long, bad int")
    out = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_reputation.judge(df, none, URL_RULES, F.lit(None).cast("long")).collect()}
    assert out[0] == ("a.example.com", "/en/712", "example.com/en/7", "allow") and out[1] == ("example.com", "/en/8", "com/en/", "block")
    assert out[2][2:] == ("com/en/", "block") and out[3][2:] == ("com/en/", "block") and out[4] == ("net", "/de/", "net/de/", "allow")
    assert out[5] == ("m.example.net", "/de/81", "example.net/de/8", "block") and out[6] == ("a.org", "/es/", "org/es/", "block") and out[7] == ("a.org", "", None, "allow")
    assert out[8] == ("", "", None, "allow") and out[9] == ("", "", None, "allow") and out[10][:3] == ("b.com", "/EN/1", None) and out[11][0] == "é.example.net"


def test_reputation_shrinks(spark):
    pages = [(i, f"http://spam.example.com/{i}", 1) for i in range(40)] + [(100 + i, f"http://good{i % 8}.example.com/{i}", 0) for i in range(80)] + [(300, "http://new.example.com/1", 1), (400, "http://once.other.org/1", 1)]
    df = spark.createDataFrame([p[:2] for p in pages], "page_id long, url string")
    outcomes = spark.createDataFrame([(p[0], p[2]) for p in pages], "item long, bad int")
    seen = df.select("page_id", url_reputation.host_of(F.col("url")).alias("host"), F.col("page_id").alias("item"))
    bound = {r.host: r.bound for r in url_reputation.host_reputation(url_reputation.count_outcomes(seen, outcomes)).collect()}
    assert bound["spam.example.com"] > 0.5 > bound["new.example.com"] and bound["good1.example.com"] < 0.3 and bound["once.other.org"] < 0.5


def test_registered_domains_and_suffixes(spark):
    cases = {"www.shop.example.com": ("example.com", "com"), "a.b.co.uk": ("b.co.uk", "co.uk"), "b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "x.com.br:8080": ("x.com.br", "com.br"),
             "u@h.example.org.": ("example.org", "org"), "10.1.2.3": ("10.1.2.3", ""), "localhost": ("localhost", "localhost"), "": ("", ""), "com.example": ("com.example", "example"), "xco.uk": ("xco.uk", "uk"), "a.me.com": ("me.com", "com")}
    df = spark.createDataFrame([(h,) for h in cases], "host string").withColumn("domain", url_reputation.domain_of(F.col("host")))
    got = {r.host: (r.domain, r.suffix) for r in df.withColumn("suffix", url_reputation.suffix_of(F.col("domain"))).collect()}
    assert got == cases


@pytest.mark.parametrize("hot", [1, 3, 1 << 20])
def test_hot_hosts_and_repeated_rows(spark, monkeypatch, hot):
    monkeypatch.setattr(url_reputation, "HOT_PAGES", hot)
    rows = [(i, f"http://bad.example.com/{i}") for i in range(30)] + [(40, "http://ok.example.org/1")] * 3 + [(50, None)] + [(100 + i, f"http://g{i % 9}.example.net/{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("bound", F.lit("clash")).withColumn("pages", F.lit(1))
    outcomes = spark.createDataFrame([(i, 1) for i in range(30)] + [(40, 0), (41, 0)] + [(100 + i, 0) for i in range(200)], "item long, bad int")
    out = url_reputation.judge(df, outcomes, (), F.col("page_id")).collect()
    assert sorted((r.page_id, r.verdict) for r in out) == sorted([(i, "block") for i in range(30)] + [(40, "allow")] * 3 + [(50, "allow")] + [(100 + i, "allow") for i in range(200)])
    assert url_reputation.judge(df.where("page_id < 0"), outcomes, (), F.col("page_id")).collect() == []
