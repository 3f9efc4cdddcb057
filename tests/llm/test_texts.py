"""Line dedup, sharding, SimHash and BPE against brute force, and on odd rows."""

from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfmatch.llm import bpe, common, hashing, lines, sharding, simhash
from shelfmatch.llm.queries import vocabulary

SMALL = "/root/testdata/sf0.001"
LINE_SPACE, UPPER = " \t\n\x0b\x0c\r", str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_lines(rows):
    first, many = {}, set()
    for doc, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(LINE_SPACE).translate(UPPER)
            if doc is not None and len(key) >= 10:
                if first.setdefault(key, doc) != doc:
                    many.add(key)
                first[key] = min(first[key], doc)
    out = []
    for doc, text in rows:
        parts = (text or "").split("\n")
        keep = [p for p in parts if doc is None or (k := p.strip(LINE_SPACE).translate(UPPER)) not in many or first[k] == doc]
        out.append((doc, text if len(keep) == len(parts) else "\n".join(keep), len(parts), len(parts) - len(keep)))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: [(x is None, str(x)) for x in r])


def test_lines_on_odd_rows(documents):
    found = lines.drop_repeated_lines(documents)
    assert found.columns == [*documents.columns, "n_lines", "n_dropped"]
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert ordered(tuple(r) for r in found.select("doc_id", "text", "n_lines", "n_dropped").collect()) == ordered(brute_lines(rows))
    assert lines.drop_repeated_lines(documents.limit(0)).count() == 0


def test_lines_in_three_documents(spark):
    docs = spark.createDataFrame([(i, "twice is fine\nthree times") for i in (1, 2)] + [(3, "three times")], "doc_id long, text string")
    found = {r.doc_id: r.text for r in lines.drop_repeated_lines(docs, min_documents=3).collect()}
    assert found == {1: "twice is fine\nthree times", 2: "twice is fine", 3: ""}


def brute_capacity(sizes, shards):
    best = {(0, 0): 0}
    sums = np.concatenate(([0], np.cumsum(sizes)))
    for k in range(1, shards + 1):
        for i in range(len(sizes) + 1):
            best[k, i] = min((max(best[k - 1, j], sums[i] - sums[j]) for j in range(i + 1) if (k - 1, j) in best), default=None)
    return int(best[shards, len(sizes)])


@pytest.mark.parametrize("sizes", [[5] * 40, [1000, 1, 1, 1, 1], [1, 2, 3], list(range(1, 60)), [1, 1, 500, 1, 1, 90, 90, 90, 1]])
def test_smallest_capacity(spark, sizes):
    rows = [((i * 7919) << 40, s) for i, s in enumerate(sizes)]
    segments = sharding.Segments(spark.createDataFrame(rows, "position long, size long").coalesce(1), 2, 16)
    assert sharding.smallest_capacity(segments, 4) == brute_capacity(sizes, 4)
    cuts = [0, *sharding.cut_points(segments, 4), sum(sizes)]
    assert all(b - a <= brute_capacity(sizes, 4) for a, b in zip(cuts, cuts[1:]))


def test_sharding(spark, documents):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = docs.unionAll(docs.where("doc_id % 3 = 0"))
    rows = sharding.shard_documents(docs).select("text", "size", "shard", "slot").collect()
    assert len(rows) == docs.count()
    by_shard = [[r for r in rows if r.shard == s] for s in range(8)]
    assert all(sorted(r.slot for r in s) == list(range(len(s))) for s in by_shard)
    assert len({(r.text, r.shard) for r in rows}) == len({r.text for r in rows})
    loads = [sum(r["size"] for r in s) for s in by_shard]
    assert max(loads) <= sum(loads) / 8 + max(len(r.text.encode()) for r in rows) * 8
    odd = sharding.shard_documents(documents, shards=3)
    assert sorted(r.slot for r in odd.collect() if r.shard == 0) == list(range(odd.where("shard = 0").count()))
    assert odd.count() == documents.count() and sharding.shard_documents(documents.limit(0)).count() == 0


def test_slots_of_many_copies_are_numbered_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 20)
    rows = [(None, "copy")] * 700 + [(5, "same id")] * 300 + [(i, f"text {i}") for i in range(1000)]
    found = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert len(found) == len(rows)
    for shard in {r["shard"] for r in found}:
        slots = sorted(r.slot for r in found if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert len({r["shard"] for r in found if r.text == "copy"}) == 1


def test_a_group_above_the_mean_leaves_no_shard_empty(spark):
    docs = spark.createDataFrame([(i, "x" * 1000) for i in range(50)] + [(100 + i, f"text {i} " * 5) for i in range(200)], "doc_id long, text string")
    loads = {r.shard: r["sum(size)"] for r in sharding.shard_documents(docs).groupBy("shard").sum("size").collect()}
    rest = sorted(loads.values())[:-1]
    assert len(loads) == 8 and max(rest) < 2 * min(rest)


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance):
    ids = {doc: doc for doc in prints}
    changed = True
    while changed:
        changed = False
        for a, b in combinations(ids, 2):
            if (prints[a] ^ prints[b]).bit_count() <= distance and ids[a] != ids[b]:
                ids[a] = ids[b] = min(ids[a], ids[b])
                changed = True
    return ids


def test_simhash(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(150)
    texts = {r.doc_id: r.text for r in docs.collect()}
    prints = {d: brute_print(t) for d, t in texts.items()}
    found = {r.doc_id: (r.fingerprint % 2**64, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert found == {d: (p, brute_components(prints, 4)[d]) for d, p in prints.items()}
    kept = {r.doc_id for r in simhash.drop_near_duplicates(docs).collect()}
    assert kept == {c for _, c in found.values()}


def test_links_of_a_large_bucket_and_of_a_chain(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL", 8)
    chain = [(1 << 4 * k) - 1 for k in range(12)]  # each four bits from the next
    ball = [0xFFFFF00000000000 ^ (1 << i) for i in range(40)]
    values = chain + ball + [2**64 - 1]
    prints = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in values], "fingerprint long")
    roots = {r.node: r.root for r in simhash.components(simhash.print_links(prints, 4)).collect()}
    assert {roots[v] for v in chain} == {0}
    assert len({roots[v - 2**64 if v >= 2**63 else v] for v in ball}) == 1
    assert -1 not in roots


@pytest.mark.parametrize("blocks", range(5, 11))
def test_pigeonhole(blocks):
    rng = np.random.default_rng(blocks)
    masks = simhash.block_masks(blocks, 4)
    for _ in range(200):
        change = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(change & m == 0 for m in masks)


def test_simhash_on_odd_rows(documents):
    rows = simhash.near_duplicates(documents).collect()
    ids = {r.doc_id: r.component_id for r in rows}
    assert len(rows) == documents.count() and ids[13] == 12 and ids[9] == ids[10] == ids[11] == 9
    assert sorted(str(r.doc_id) for r in simhash.drop_near_duplicates(documents).collect()) == ["12", "14", "3", "5", "5", "9", "None"]
    assert simhash.near_duplicates(documents.limit(0)).count() == 0


@pytest.fixture(scope="module")
def codecs():
    return bpe.Codec(vocabulary()), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


PARTS = ["'s", "'t", "'re", "'ll", "'", "  ", "\n", " ", "\t", "s", "é", "中", "a", "1", "!", "<|endoftext|>", " ", "　", "re", "\x1c", "½", "🙂"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=4)), max_size=20), min_size=1, max_size=5))
def test_bpe_equals_the_library(codecs, parts):
    ours, theirs = codecs
    texts = ["".join(p) for p in parts]
    assert [e.tolist() for e in ours.encode_all(texts)] == [e.ids for e in theirs.encode_batch(texts, add_special_tokens=False)]


def test_characters_newer_than_the_rules_are_no_letters(codecs):
    ours, theirs = codecs
    texts = [c + "'s" for c in "\u0558\u0c5c\U000187f8\U00011de0\U0002b73a\U000323b0\U00033479\U0003347a\U000323af\U0003d000"]
    assert [e.tolist() for e in ours.encode_all(texts)] == [e.ids for e in theirs.encode_batch(texts, add_special_tokens=False)]


def test_bpe_of_long_words_and_texts(codecs, monkeypatch):
    ours, theirs = codecs
    monkeypatch.setattr(bpe, "BLOCK", 64)
    for text in ("a" * 3000, "ab" * 2000, "é" * 1500, " " * 2000, "Ich gehe heim. It's 12 o'clock!  \n\n Ja?" * 40):
        ids = theirs.encode(text, add_special_tokens=False).ids
        assert ours.encode(text).tolist() == ids and ours.decode(np.array(ids)) == text


@pytest.mark.parametrize("same", [False, True])  # True: all words of one length share one hash
def test_bpe_of_words_that_only_share_a_hash(codecs, monkeypatch, same):
    _, library = codecs
    codec = bpe.Codec(vocabulary())
    if same:
        monkeypatch.setattr(bpe, "piece_hashes", lambda raw, starts, ends: (ends - starts).astype(np.uint64) << np.uint64(50))
    bits = [bin(i).count("1") % 2 for i in range(4096)]
    words = ["".join("ab"[b ^ flip] for b in bits[:n]) for n in (1024, 2048, 4096) for flip in (0, 1)]
    texts = [" ".join(words), *words, *reversed(words), "these words have their own lengths and letters", "those swear huge"]
    for _ in range(2):  # the second time from the cache
        for text, ids in zip(texts, codec.encode_all(texts)):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids and codec.decode(ids) == text


def test_piece_hashes_depend_on_the_bytes_alone():
    rng = np.random.default_rng(2)
    raw = rng.integers(97, 100, 3000).astype(np.uint8)
    starts = rng.integers(0, 2000, 4000)
    ends = starts + rng.integers(0, 12, 4000)
    ends[:20] = starts[:20] + 700
    found = hashing.piece_hashes(raw, starts, ends)
    pieces = [raw[a:b].tobytes() for a, b in zip(starts, ends)]
    assert len(set(zip(pieces, found.tolist()))) == len(set(pieces)) == len(set(found.tolist()))


def test_bpe_columns(documents):
    source = vocabulary()
    found = bpe.decode(bpe.encode(documents, source, ids="n"), source, ids="n")
    assert found.count() == documents.count()
    assert all(r.decoded == (r.text or "") for r in found.collect())
    assert bpe.encode(documents.limit(0), source).count() == 0
    odd = bpe.decode(documents.limit(1).selectExpr("array(72, null, -1, 99999999, 72) as ids"), source).first()
    assert odd.decoded == 2 * bpe.Codec(source).decode(np.array([72]))


@pytest.mark.parametrize("heavy", [1, 10, 4096])
def test_join_counted(spark, monkeypatch, heavy):
    """Common and rare keys give the rows of a plain join, whichever way they go; keys without a group give none."""
    monkeypatch.setattr(common, "HEAVY", heavy)
    keys = [0] * 60 + [1] * 25 + [2] * 3 + [3, 4, 4, None]
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, k int")
    groups = spark.createDataFrame([(k, keys.count(k), f"g{k}") for k in (0, 1, 2, 4)], "k int, n long, name string")
    found = common.join_counted(rows, groups, ["k"], len(keys))
    assert found.columns == ["k", "id", "name"]
    assert sorted(tuple(r) for r in found.collect()) == sorted((k, i, f"g{k}") for i, k in enumerate(keys) if k in (0, 1, 2, 4))
    assert common.join_counted(rows.limit(0), groups.limit(0), ["k"], 0).isEmpty()


def test_hash_sample(spark):
    """The least hashes of all keys, once each, whatever the part of the hashes that is looked at."""
    rows = spark.range(5000).selectExpr("id % 3000 as k", "id as v")
    hashes = [r.h for r in rows.selectExpr("xxhash64(k) as h").distinct().orderBy("h").limit(50).collect()]
    found = common.hash_sample(rows, "k", "v", 5000, 50)
    assert [r.h for r in found.collect()] == hashes and all(r.v < 3000 for r in found.collect())
    assert common.hash_sample(rows, "k", "v", 5000, 9000).count() == 3000
    assert common.hash_sample(rows.limit(0), "k", "v", 0, 9).isEmpty()
