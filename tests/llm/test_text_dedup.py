"""Near-duplicates and substring dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from echoloom.llm import near_dup, suffix_dedup
from echoloom.llm.queries import QUERIES

WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "pé", "ra") for b in ("t", "sen", "dor", "", "x", "ß")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", ".", "\n"]) for _ in range(n))


def documents(seed):
    rng = random.Random(seed)
    docs = [(i, prose(rng, rng.choice([0, 1, 3, 4, 30, 120]))) for i in range(60)]
    passage = prose(rng, 25)
    for i in range(60, 150):
        base = rng.choice(docs)[1].split(" ")
        for _ in range(rng.choice([0, 1, 2, 5, 9])):
            if base:
                base[rng.randrange(len(base))] = rng.choice(WORDS)
        text = " ".join(base)
        if rng.random() < 0.3:
            text = prose(rng, 9) + " " + passage + " " + text
        docs.append((i, text))
    docs += [(150, None), (151, ""), (152, " \n\t"), (153, "one"), (154, "one"), (155, "ONE"), (3, docs[3][1]), (3, "another text under the same id, long enough to be held against others")]
    docs += [(None, docs[40][1]), (None, "an own text without an id"), (156, "z" * 400), (157, "z" * 120), (158, "😀é" * 90)]
    rng.shuffle(docs)
    return docs


def shingles(text, size):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute_components(docs, size):
    sets = [shingles(t, size) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((d, len(sets[i]), least.get(find(i)), d is not None and d == least.get(find(i))) for i, (d, _) in enumerate(docs)), key=str)


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates_equal_brute_force(spark, size):
    docs = documents(size)
    found = near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), size, 80)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found.collect()), key=str) == brute_components(docs, size)


def test_large_families_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_BYTES", 2000)
    rng = random.Random(9)
    base = [rng.choice(WORDS) + str(i) for i in range(60)]
    docs = []
    for i in range(120):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3])):
            words[rng.randrange(60)] = "new%d" % rng.randrange(4)
        docs.append((i, " ".join(words[: rng.choice([48, 55, 60])])))
    found = near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 4, 80)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found.collect()), key=str) == brute_components(docs, 4)


def test_most_of_a_large_family_is_covered_by_hubs(spark, monkeypatch):
    """The tasks after covering hold few of the rows, and every row as often as what is open asks for."""
    monkeypatch.setattr(near_dup, "BLOCK_BYTES", 4000)
    rng = random.Random(10)
    base = [rng.choice(WORDS) + str(i) for i in range(80)]
    docs = []
    for i in range(300):
        words = list(base)
        for _ in range(rng.choice([0, 1, 1, 2])):
            words[rng.randrange(80)] = f"new{i}"
        docs.append((i, " ".join(words)))
    docs += [(1000 + i, " ".join(base[:40] + [f"other{i}x{k}" for k in range(40)])) for i in range(3)]
    seen = []
    whole = near_dup._links
    monkeypatch.setattr(near_dup, "_links", lambda rows, *rest: seen.append(rows.groupBy("task", "family").count().agg({"count": "sum", "*": "count"}).first()) or whole(rows, *rest))
    found = near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 4, 80)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found.collect()), key=str) == brute_components(docs, 4)
    covering = sum(r["sum(count)"] or 0 for r in seen[1:-1])
    assert covering <= 4 * len(docs) and (seen[-1]["sum(count)"] or 0) <= 3 * len(docs)


def test_clashing_columns_and_long_texts(spark):
    rng = random.Random(13)
    words = [rng.choice(WORDS) + str(i % 9000) for i in range(150_000)]
    docs = [(1, " ".join(words)), (2, " ".join(words[:-900])), (3, " ".join(words[60_000:])), (4, "a b c d e f"), (4, "a b c d e f"), (5, None)]
    table = spark.createDataFrame([(i, t, "x", "y", 1, "z") for i, t in docs], "doc_id long, text string, class string, family string, n_shingles int, signature string")
    found = near_dup.near_duplicates(table, 4, 80)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found.collect()), key=str) == brute_components(docs, 4)


def test_one_of_each_group_stays(spark):
    docs = documents(5)
    rows = [(i, t, "x%s" % k, k) for k, (i, t) in enumerate(docs)]
    table = spark.createDataFrame(rows, "doc_id long, text string, class string, kept int")
    out = near_dup.keep_one_of_each(table, 5, 80)
    assert out.columns == table.columns
    got = [(r.doc_id, r.text) for r in out.collect()]
    expected = set()
    for (doc, text), (_, _, component, kept) in zip(sorted(docs, key=str), _aligned(docs)):
        if kept or (doc is None and component is None):
            expected.add((doc, frozenset(shingles(text, 5))))
    assert {(d, frozenset(shingles(t, 5))) for d, t in got} == expected
    assert len(got) == len(expected)


def _aligned(docs):
    by_row = brute_rows(docs, 5)
    return [by_row[i] for i in sorted(range(len(docs)), key=lambda i: str(docs[i]))]


def brute_rows(docs, size):
    sets = [shingles(t, size) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [(d, len(sets[i]), least.get(find(i)), d is not None and d == least.get(find(i))) for i, (d, _) in enumerate(docs)]


def brute_removal(docs, size):
    first = {}
    for doc, text in docs:
        data = (text or "").encode()
        if doc is not None:
            for i in range(len(data) - size + 1):
                s = data[i : i + size]
                first[s] = min(doc, first.get(s, doc))
    out = []
    for doc, text in docs:
        data = (text or "").encode()
        gone = [False] * len(data)
        if doc is not None:
            for i in range(len(data) - size + 1):
                if first[data[i : i + size]] < doc:
                    gone[i : i + size] = [True] * size
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("size,batch,step", [(50, 4 << 20, 1 << 19), (50, 3000, 64), (99, 5000, 300), (12, 20000, 1000)])
def test_substring_digests_equal_brute_force(spark, monkeypatch, size, batch, step):
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", batch)
    monkeypatch.setattr(suffix_dedup, "STEP", step)
    docs = documents(size)
    found = suffix_dedup.substring_digests(spark.createDataFrame(docs, "doc_id long, text string"), size)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_removal(docs, size)


def test_family_equals_brute_force_also_where_words_clash(monkeypatch):
    rng = np.random.default_rng(3)
    for word in (suffix_dedup.LogFamily.word, staticmethod(lambda key, check: (key + check) % np.uint64(4))):
        monkeypatch.setattr(suffix_dedup.LogFamily, "word", word)
        family, first, order = suffix_dedup.LogFamily(), {}, 0
        for size in (0, 5, 200, 1, 40, 300, 7):
            key, check = rng.integers(0, 12, (2, size)).astype(np.uint64)
            own = order + np.sort(rng.integers(0, 30, size))
            order += 30
            for pair, o in zip(zip(key, check), own):
                first[pair] = min(o, first.get(pair, o))
            want = [first[pair] < o for pair, o in zip(zip(key, check), own)]
            assert family.add(key, check, own).tolist() == want
        key, check, least = family.merged()
        assert dict(zip(zip(key, check), least)) == first and len(key) == len(first)


def test_batches_are_hashed_in_slices_and_sorted_by_one_word(monkeypatch):
    texts = [(i, f"{i} " + " ".join(f"w{(i * 7 + k * k) % 997}" for k in range(900))) for i in range(200)]
    held = []
    hashed = suffix_dedup.PrefixHash
    monkeypatch.setattr(suffix_dedup, "PrefixHash", lambda buf: held.append(len(buf)) or hashed(buf))
    monkeypatch.setattr(np, "lexsort", lambda keys, of=np.lexsort: of(keys) if len(keys[0]) <= len(texts) else pytest.fail("a sort by several keys"))
    table = pa.table({"doc_id": [i for i, _ in texts], "text": [t for _, t in texts]})
    posts = suffix_dedup._post(50, 1)((pa.scalar(0),), table)
    suffix_dedup._first_scan((pa.scalar(0),), posts)
    assert sum(held) == sum(len(t) for _, t in texts) > 3 * max(held) and max(held) <= 1 << 17


def test_substring_query_equals_brute_force(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    found = QUERIES["op8_suffix_family"](spark, small)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_removal(docs, 50)


def test_near_dup_query_equals_brute_force(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    found = QUERIES["op6_minhash_near_dup"](spark, small)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found.collect()), key=str) == brute_components(docs, 4)


def test_removal_keeps_characters_whole(spark):
    a = "é" * 80 + " the rest of the first one"
    docs = [(1, a, "l", 9), (2, "ü" + "é" * 70 + "ü and its own end", "l", 9), (3, "é" * 80, "l", 9), (4, None, "l", None)]
    table = spark.createDataFrame(docs, "doc_id long, text string, rest string, n_chars long")
    out = {r.doc_id: r for r in suffix_dedup.remove_substrings(table, 99).collect()}
    assert out[1].text == a and out[1].n_chars == 9
    assert out[2].text == "üü and its own end" and out[2].n_chars == 18
    assert 3 not in out and out[4].text is None and out[4].rest == "l"


@pytest.mark.parametrize("limit", [0, 1000])
def test_components_by_stars_and_by_thinning(spark, monkeypatch, limit):
    from echoloom.llm import components

    monkeypatch.setattr(components, "THIN_LINKS", limit)
    links = [(i, i + 1) for i in range(1, 30)] + [(100, 1), (50, 60), (60, 50), (70, 70), (None, 1), (51, 60)]
    found = components.smallest_reachable(spark.createDataFrame(links, "a long, b long"))
    expected = {**{i: 1 for i in range(1, 31)}, 100: 1, 50: 50, 60: 50, 51: 50}
    assert {r.node: r.root for r in found.collect()} == expected and found.count() == len(expected)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert near_dup.near_duplicates(none).collect() == []
    assert near_dup.keep_one_of_each(none).collect() == []
    assert suffix_dedup.substring_digests(none).collect() == []
    assert suffix_dedup.remove_substrings(none).collect() == []
