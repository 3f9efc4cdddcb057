"""Language ID, quality rules, cross-entropy, decontamination, nearest neighbours and WARC."""

import base64
import hashlib
import math
import struct

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from shelfmatch.llm import cross_entropy, decontaminate, hashing, language, nearest, quality, warc
from shelfmatch.llm.queries import remainder

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    model = language.learn(docs.where(remainder(5) != 0))
    held = language.identify(docs.where(remainder(5) == 0).drop("doc_id", "source"), model).collect()
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in held)
    assert language.drop_unidentified(docs, model).count() == docs.count()


def test_grams_do_not_depend_on_how_a_text_is_cut(monkeypatch):
    text = "Ein Wort, zwei  Wörter und ein langes Ende " * 20
    whole = np.concatenate(list(language.pieces(text)))
    for piece in (7, 64, 101):
        monkeypatch.setattr(language, "PIECE", piece)
        assert np.concatenate(list(language.pieces(text))).tolist() == whole.tolist()


def test_foreign_texts_go_and_short_ones_stay(spark):
    model = language.learn(spark.read.parquet(f"{SMALL}/documents.parquet"))
    rows = [(1, "A."), (2, "Это совсем другой язык"), (3, "1234 ."), (4, None), (5, "これは別の言語です")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.doc_id for r in language.drop_unidentified(docs, model).collect()] == [1]
    assert {r.doc_id: r.lang_pred == "und" for r in language.identify(docs, model).collect()} == {1: False, 2: False, 3: True, 4: True, 5: False}


def test_filters_return_every_language_of_a_gram(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    counts = {}
    for r in language.count_grams(docs, "lang", "text").collect():
        counts.setdefault(r.lang, {})[r.gram] = r.n
    brute = {}
    for r in docs.select("lang", "text").collect():
        for g in language.grams(r.text.lower().encode()).tolist():
            brute.setdefault(r.lang, {}).setdefault(g, 0)
            brute[r.lang][g] += 1
    assert counts == brute
    model = language.learn(docs)
    shares = {name: {g: n / sum(c.values()) for g, n in c.items()} for name, c in counts.items()}
    for k, name in enumerate(model.languages):
        kept = [g for g, s in shares[name].items() if s >= language.LEAST_SHARE and s >= 0.2 * max(x.get(g, 0) for x in shares.values())]
        assert model.hits(np.array(kept, np.uint32))[k] == len(kept)


def test_language_on_odd_rows(spark, documents):
    model = language.learn(documents)
    found = {r.doc_id: r for r in language.identify(documents.withColumn("score", F.lit("old")), model).collect()}
    assert found[9].lang_pred == found[10].lang_pred == found[11].lang_pred == "und" and found[9].score == 0
    assert found[12].lang_pred == "de" and found[14].lang_pred == "fr"
    empty = language.learn(documents.limit(0))
    assert language.identify(documents, empty).where("lang_pred <> 'und'").count() == 0
    assert language.drop_unidentified(documents, empty).count() == 0
    many = spark.createDataFrame([(f"l{i:02}", f"{chr(97 + i % 26)}{chr(97 + i // 26)}qq " * 30) for i in range(90)], "lang string, text string")
    assert language.identify(many, language.learn(many)).where("lang = lang_pred").count() == 90


def test_quality_rules(spark):
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.score_quality(docs, labels.where(remainder(3) != 1)).join(labels, "doc_id").where(remainder(3) == 1).collect()
    assert sum((r.score >= 0.5) == r.quality for r in found) / len(found) > 0.95


def test_rules_as_columns(spark):
    rules = quality.Rules(-1.0, [((("a", "<=", 2.0),), 3.0), ((("a", ">", 1.0), ("b", "<=", 0.0)), -2.0)])
    rows = spark.createDataFrame([(0.0, 0.0), (1.5, 0.0), (1.5, 1.0), (3.0, -1.0)], "a double, b double")
    scores = [r.s for r in rows.select("a", "b", rules.score(F.col).alias("s")).orderBy("a", "b").collect()]
    assert scores == pytest.approx([1 / (1 + np.exp(-x)) for x in (2.0, 0.0, 2.0, -3.0)])
    dump = "Model\n  Tree 0 (weight 1.0):\n    If (feature 0 <= 5.0)\n     If (feature 1 <= 2.0)\n      Predict: 0.0\n     Else (feature 1 > 2.0)\n      Predict: 1.0\n    Else (feature 0 > 5.0)\n     Predict: 1.0\n"
    a, b = quality.STATISTICS[:2]
    assert set(quality.tree_paths(dump)) == {((a, "<=", 5.0),), ((a, ">", 5.0),), ((a, "<=", 5.0), (b, "<=", 2.0)), ((a, "<=", 5.0), (b, ">", 2.0))}


def test_quality_on_odd_rows(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score_quality(documents, none).collect()} == {0.5}
    one = spark.createDataFrame([(3, 1), (None, 0), (5, None)], "doc_id long, quality int")
    assert quality.score_quality(documents, one).where("score > 0.9").count() == documents.count()
    assert quality.score_quality(documents.limit(0), one).count() == 0


def brute_losses(texts, targets, vocabulary, size):
    counts = np.zeros((2, size, size))
    for text, target in zip(texts, targets):
        before = cross_entropy.START
        for t in cross_entropy.tokens(text):
            now = vocabulary.get(t, 0)
            counts[1, before, now] += 1
            counts[0, before, now] += target
            before = now
    return brute_model(counts)


def brute_model(counts):
    """-log p(token | token before) of (target, background) counts, by the stated formula and one number at a time: the
    background's counts are scaled to the target's size; a context is filled up by 50 tokens of the unigram model, which
    gets one of each token."""
    size = len(counts[0])
    sums = [sum(map(sum, table.tolist())) for table in counts]
    out = np.zeros((2, size, size))
    for m, table in enumerate(counts.tolist()):
        scale = sums[0] / sums[m] if sums[0] and sums[1] else 1.0
        single = [(scale * sum(row[w] for row in table) + 1) / (scale * sums[m] + size) for w in range(size)]
        for v, row in enumerate(table):
            context = scale * sum(row) + 50
            for w, n in enumerate(row):
                out[m, v, w] = -math.log((scale * n + 50 * single[w]) / context)
    return out


def test_sums_of_many_texts_are_added_in_groups(spark, monkeypatch):
    """Groups of few texts and buckets of few tokens give what one group gives; a text of very many pairs, equal texts
    and one word that always follows a new one are among them."""
    docs = [(i, " ".join(f"new{i}x{k} hot" for k in range(50))) for i in range(60)] + [(100, " ".join(f"a{k}" for k in range(5000)))] + [(101, "same words here")] * 3 + [(102, None)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    good = spark.createDataFrame([(i,) for i in range(0, 60, 2)], "doc_id long")

    def scores():
        return sorted((r.doc_id, r.n_tokens, r.target_loss or 0, r.background_loss or 0) for r in cross_entropy.score_documents(table, good).collect())

    whole = scores()
    assert len(whole) == len(docs)
    for texts, bucket, known in ((7, 500, 1 << 20), (1, 100, 1)):
        monkeypatch.setattr(cross_entropy, "TEXTS_TOGETHER", texts)
        monkeypatch.setattr(cross_entropy, "BUCKET_TOKENS", bucket)
        monkeypatch.setattr(cross_entropy, "KNOWN_WORDS", known)
        assert np.array(scores()) == pytest.approx(np.array(whole))


def test_cross_entropy(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    good = labels.where("quality = 1").select("doc_id")
    size = 64
    found = {r.doc_id: r for r in cross_entropy.score_documents(docs, good, size).collect()}
    rows, ids = docs.collect(), {r.doc_id for r in good.collect()}
    vocabulary = cross_entropy.learn_vocabulary(docs, "text", size)
    words = [t for r in rows for t in cross_entropy.tokens(r.text)]
    top = sorted(set(words), key=lambda w: (-words.count(w), w))[:5]
    assert [vocabulary[w] for w in top] == [2, 3, 4, 5, 6] and len(vocabulary) == size - 2
    table = brute_losses([r.text for r in rows], [r.doc_id in ids for r in rows], vocabulary, size)
    assert np.exp(-table.astype(float)).sum(axis=2) == pytest.approx(np.ones((2, size)), abs=1e-4)
    for r in rows[:20]:
        n = [cross_entropy.START] + [vocabulary.get(t, 0) for t in cross_entropy.tokens(r.text)]
        means = table[:, n[:-1], n[1:]].mean(axis=1)
        assert (found[r.doc_id].target_loss, found[r.doc_id].background_loss) == pytest.approx(tuple(means), rel=1e-5)
        assert found[r.doc_id].score == pytest.approx(means[0] - means[1], rel=1e-4, abs=1e-4)


def test_cross_entropy_on_odd_rows(spark, documents):
    none = spark.createDataFrame([(None,)], "doc_id long")
    found = {r.doc_id: r for r in cross_entropy.score_documents(documents, none).collect()}
    assert found[9].n_tokens == found[10].n_tokens == 0 and found[9].score is None and found[12].score is not None
    assert cross_entropy.score_documents(documents.limit(0), none).count() == 0


def brute_similarity(text, item, width=5):
    import re

    words, own = (re.findall(r"[0-9a-z\x80-\U0010ffff]+", t.lower()) for t in (text, item))
    if not own:
        return 0.0
    width = min(width, len(own))

    def bag(ws):
        found = {}
        for i in range(len(ws) - width + 1):
            found[tuple(ws[i:i + width])] = found.get(tuple(ws[i:i + width]), 0) + 1
        return found

    b, best = bag(own), 0.0
    for i in range(len(words) - len(own) + 1):
        a = bag(words[i:i + len(own)])
        both = sum(min(a.get(k, 0), n) for k, n in b.items())
        best = max(best, both / (sum(a.values()) + sum(b.values()) - both))
    return best


def test_contamination(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choice(words, n))) for i, n in enumerate((3, 5, 12, 40, 40, 90, 200))]
    docs = []
    for k in range(120):
        parts = rng.choice(words, 150).tolist()
        item = items[k % len(items)][1].split()
        for at in rng.choice(len(item), k // 30, replace=False) if len(item) > 40 else []:
            item[at] = "changed"
        parts[60:60] = [w.upper() + "," for w in item]
        docs.append((k, " ".join(parts) if k % 3 else " ".join(parts[:60] + parts[60 + len(item):])))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items + [(90, None), (None, items[3][1]), (91, " ")], "item_id long, text string")
    brute = {(d, i): s for d, t in docs for i, x in [*items, (None, items[3][1])] if (s := brute_similarity(t, x)) >= 0.8}
    assert {i for _, i in brute} >= {None, 3}
    for blocks, piece in ((200_000, 1 << 20), (60, 300)):
        monkeypatch.setattr(decontaminate, "BLOCK_SHINGLES", blocks)
        monkeypatch.setattr(decontaminate, "PIECE_BYTES", piece)
        found = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.find_contamination(table, benchmark).collect()}
        assert found == pytest.approx(brute)
        kept = {r.doc_id for r in decontaminate.drop_contaminated(table, benchmark).collect()}
        assert kept == {d for d, _ in docs} - {d for d, _ in brute}


def test_windows_within_the_radius_are_never_lost():
    rng = np.random.default_rng(5)
    own = rng.integers(0, 2**63, 1, np.uint64)
    for _ in range(300):
        other = int(own[0]) ^ sum(1 << int(b) for b in rng.choice(64, 23, replace=False))
        assert any((other >> 16 * k & 0xFFFF) in decontaminate.near_values(int(own[0]) >> 16 * k & 0xFFFF, 5) for k in range(4))


def twins(n):
    """Two different words of ``n`` letters (a power of two) whose sums of powers agree modulo 2**64 from 1,024 on."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return tuple("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))


@pytest.mark.parametrize("same", [False, True])  # True: all words share one hash
def test_words_that_only_share_a_hash_are_not_held(spark, monkeypatch, same):
    if same:
        monkeypatch.setattr(decontaminate, "piece_hashes", lambda raw, starts, ends: np.zeros(len(starts), np.uint64))
    docs, items = [], []
    for k, n in enumerate((1024, 2048, 4096)):
        one, other = twins(n)
        items.append((k, f"one two three four five {one} six seven eight nine ten"))
        docs += [(10 * k, f"before one two three four five {other} six seven eight nine ten after"), (10 * k + 1, f"x {items[-1][1]} y")]
    run = decontaminate._matcher(items, 5, 0.8, 23).func
    found = next(run(iter([pa.array([t for _, t in docs])]))).to_pylist()
    assert [[x["item_id"] for x in row] for row in found] == [[], [0], [], [1], [], [2]]
    assert len({int(h) for n in (1024, 4096) for w in twins(n) for h in hashing.piece_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([n]))}) == 4


def test_contamination_on_odd_rows(spark, documents):
    benchmark = spark.createDataFrame([(1, "no id"), (2, "the same line of text")], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_contamination(documents, benchmark).collect()}
    assert found == {(None, 1), (None, 2), (3, 2), (5, 2)}
    assert {r.doc_id for r in decontaminate.drop_contaminated(documents, benchmark).collect()} == {9, 10, 11, 12, 13, 14}
    assert decontaminate.find_contamination(documents, benchmark.limit(0)).count() == 0
    assert decontaminate.drop_contaminated(documents, benchmark.limit(0)).count() == documents.count()
    assert decontaminate.find_contamination(documents.limit(0), benchmark).count() == 0


def test_nearest_recall(spark):
    rows = spark.read.parquet(f"{MIDDLE}/embeddings.parquet")
    found = {}
    for r in nearest.search(rows, F.col("vec_id") % 20 == 0).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    ids, matrix = zip(*[(r.vec_id, r.embedding) for r in rows.collect()])
    matrix, hits = np.array(matrix, float), 0
    for q, near in found.items():
        scores = matrix @ matrix[ids.index(q)]
        scores[ids.index(q)] = -np.inf
        true = {ids[i] for i in np.argsort(-scores)[:20]}
        near.sort()
        assert [n for n, _, _ in near] == list(range(1, 21))
        assert [s for _, _, s in near] == pytest.approx(sorted((scores[ids.index(v)] for _, v, _ in near), reverse=True))
        hits += len(true & {v for _, v, _ in near})
    assert hits / (20 * len(found)) >= 0.9 and len(found) == 25


def test_nearest_on_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(nearest, "CELL", 16)
    rng = np.random.default_rng(1)
    same = [float(x) for x in rng.standard_normal(8)]
    rows = [(i, same) for i in range(60)] + [(100 + i, [float(x) for x in rng.standard_normal(8)]) for i in range(90)]
    odd = [(300, None), (301, [0.0] * 8), (302, [float("nan")] + same[1:]), (303, [None] + same[1:]), (304, []), (305, same[:3]), (None, same), (0, same)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("id", F.lit(1)).withColumn("vec", F.lit("x"))
    found = nearest.search(table, F.col("vec_id") % 20 == 0, recall=1.0).collect()
    by_query = {q: sorted((r["rank"], r.vec_id) for r in found if r.query_id == q) for q in {r.query_id for r in found}}
    assert set(by_query) == {0, 20, 40, 100, 120, 140, 160, 180}
    matrix, place = np.array([v for _, v in rows]), {i: k for k, (i, _) in enumerate(rows)}
    for query, near in by_query.items():
        scores = sorted((-round(float(s), 9), i) for (i, _), s in zip(rows, matrix @ matrix[place[query]]) if i != query)
        assert [v for _, v in near] == [i for _, i in scores[:20]]
    few = nearest.search(table.where("vec_id between 99 and 103"), F.col("vec_id") == 100).collect()
    assert len(few) == 3
    assert nearest.search(table.limit(0), F.lit(True)).count() == 0


def written(spark, tmp_path, rows, **options):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("deal", F.lit(1)).withColumn("payload", F.lit("x"))
    path = str(tmp_path / "archives")
    warc.write_archives(pages, path, **options)
    return path, warc.read_archives(spark, path).collect()


def test_archives_round_trip(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"<p>page {i % 40} größe</p>" * (i % 7)) for i in range(300)]
    rows += [(400, "a\r\nb", None), (None, None, "no id"), (None, "u", "no id"), (401, "x", "y" * 300_000), (402, "x", "z"), (402, "x", "z")]
    path, found = written(spark, tmp_path, rows)
    last = {}
    for i, _, html in rows:
        if i is not None:
            last[html or ""] = max(last.get(html or "", -1), i)
    assert len(found) == len(rows) and all(r.problem is None for r in found)
    for r in found:
        if r.page_id is None:
            assert r.record_type == "response" and bytes(r.payload) == b"no id"
            continue
        html = next(h or "" for i, _, h in rows if i == r.page_id)
        data = html.encode()
        assert (r.payload_bytes, r.payload_digest) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        assert r.refers_to == (None if last[html] == r.page_id else last[html])
        assert r.record_type == ("response" if r.refers_to is None else "revisit")
        assert (bytes(r.payload) if r.payload is not None else None) == (data if r.refers_to is None else None)
    contents = [bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect()]
    assert all(struct.unpack("<I", c[:4])[0] == warc.DICTIONARY_MAGIC for c in contents)
    magics = [m for c in contents for m, _ in warc.frames_of(memoryview(c))]
    assert magics.count(warc.FRAME_MAGIC) == len(rows)


def test_small_payloads_are_all_responses(spark, tmp_path):
    _, found = written(spark, tmp_path, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], least_bytes=3)
    assert {r.page_id: r.refers_to for r in found} == {1: None, 2: None, 3: 4, 4: None}


def test_empty_table(spark, tmp_path):
    assert written(spark, tmp_path, [])[1] == []


def test_damaged_archives():
    samples = [f"<html><p>sample {i} of a page</p></html>".encode() * 20 for i in range(300)]
    dictionary = warc.train_dictionary(samples)
    frame = warc.dictionary_frame(dictionary)
    writer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    good = warc.record_bytes(7, "http://x", samples[0], None, "2026-01-01T00:00:00Z")
    plain = struct.pack("<II", warc.DICTIONARY_MAGIC, len(dictionary)) + dictionary
    for head in (frame, plain):
        first, = warc.parse_archive(head + writer.compress(good))
        assert first["problem"] is None and first["payload"] == samples[0] and first["page_id"] == 7

    def problems(*records):
        return [r["problem"] for r in warc.parse_archive(frame + b"".join(writer.compress(r) for r in records))]

    assert problems(good[:-6] + b"\r\n\r\n", good) == ["the block is not as long as stated", None]
    assert problems(good.replace(b"of a page", b"of a cage", 1)) == ["the block has another digest"]
    assert problems(good.replace(b"WARC/1.1", b"HTTP/1.1")) == ["no WARC header"]
    assert problems(good.replace(b"WARC-Date", b"WARC-Data")) == ["no warc-date"]
    whole = frame + writer.compress(good)
    assert [r["problem"] for r in warc.parse_archive(whole + whole[len(frame):-5])] == [None, "the archive ends inside a frame"]
    assert [r["problem"] for r in warc.parse_archive(b"nonsense")] == ["no frame begins with 0x736e6f6e"]


def test_cross_entropy_over_every_word(spark, monkeypatch):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(1500)] + ["long" * 20]
    rows = [(i, " ".join([*rng.choice(words[:40], 30), *rng.choice(words, 30)])) for i in range(200)]
    rows += [(200, words[-1]), (201, " ".join(words)), (None, "w1 w2 once"), (7, rows[7][1]), (202, ""), (203, "w3 " * 3000)]
    docs, good = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i,) for i in range(0, 204, 3)], "doc_id long")
    every = sorted({t for _, x in rows for t in cross_entropy.tokens(x)})
    vocabulary = {w: i + 2 for i, w in enumerate(every)}
    table = brute_losses([x for _, x in rows], [i is not None and i % 3 == 0 for i, _ in rows], vocabulary, len(every) + 2)
    brute = []
    for i, x in rows:
        n = [cross_entropy.START] + [vocabulary[t] for t in cross_entropy.tokens(x)]
        brute.append((-1 if i is None else i, len(n) - 1, *(table[:, n[:-1], n[1:]].mean(axis=1) if len(n) > 1 else (0, 0))))
    for common, bucket in ((1 << 17, 1 << 21), (50, 1000), (0, 1000)):
        monkeypatch.setattr(cross_entropy, "COMMON_PAIRS", common)
        monkeypatch.setattr(cross_entropy, "BUCKET_TOKENS", bucket)
        found = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.target_loss or 0, r.background_loss or 0) for r in cross_entropy.score_documents(docs, good).collect())
        assert np.array(found) == pytest.approx(np.array(sorted(brute)), rel=1e-5, abs=1e-5)


def test_texts_shorter_than_an_item(spark, monkeypatch):
    rng = np.random.default_rng(6)
    item = [f"w{i}" for i in range(100)]
    docs = [(n, " ".join(item[:n])) for n in (3, 50, 80, 81, 90, 95, 99)]
    docs += [(200 + k, " ".join(w for i, w in enumerate(item) if i not in rng.choice(100, k, replace=False))) for k in range(1, 6)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, "a b c d"), (3, " ".join(item[:97]))], "item_id long, text string")

    def whole(text, own):
        a, b = ({tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (text.split(), own.split()))
        return len(a & b) / len(a | b)

    brute = {(d, 1): s for d, t in docs if (s := whole(t, " ".join(item))) >= 0.8}
    assert (95, 1) in brute and (81, 1) in brute and (80, 1) not in brute
    for piece in (1 << 20, 100):
        monkeypatch.setattr(decontaminate, "PIECE_BYTES", piece)
        found = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.find_contamination(table, benchmark).collect()}
        assert {k: v for k, v in found.items() if k[1] == 1} == pytest.approx(brute)
        kept = {r.doc_id for r in decontaminate.drop_contaminated(table, benchmark).collect()}
        assert kept.isdisjoint({d for d, _ in brute}) and {3, 50} <= kept


def test_archives_of_repeated_ids_are_dealt(spark, tmp_path):
    rng = np.random.default_rng(8)
    texts = [rng.bytes(1000).hex() for _ in range(300)]
    rows = [(7, "u", x) for x in texts] + [(7, "u", texts[0])] * 100 + [(9, "u", texts[0])] + [(None, "u", texts[1])] * 200 + [(100 + i, "u", x) for i, x in enumerate(texts)]
    path, found = written(spark, tmp_path, rows, archive_bytes=100_000)
    assert len(found) == len(rows) and all(r.problem is None for r in found)
    last = {t: 100 + i for i, t in enumerate(texts)}
    digest = {base64.b32encode(hashlib.sha1(t.encode()).digest()).decode(): t for t in texts}
    for r in found:
        refers_to = last[digest[r.payload_digest]]
        assert r.refers_to == (None if r.page_id in (None, refers_to) else refers_to)
    files = [sum(1 for _ in warc.parse_archive(bytes(r.content))) for r in spark.read.format("binaryFile").load(path).collect()]
    assert max(files) <= 150  # 901 rows; 400 of them have one id, 200 none


def test_nearest_recall_beside_very_long_vectors(spark):
    rng = np.random.default_rng(9)
    matrix = rng.standard_normal((3000, 32))
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    matrix[[5, 6, 7]] *= np.array([[1e5], [1e6], [1e60]])
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(matrix)], "vec_id long, embedding array<double>")
    found = {}
    for r in nearest.search(table, F.col("vec_id") % 60 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q, near in found.items():
        scores = matrix @ matrix[q]
        scores[q] = -np.inf
        hits += len(near & set(np.argsort(-scores)[:20].tolist()))
    assert len(found) == 50 and hits / 1000 >= 0.9


def test_lists_of_two_levels(spark, monkeypatch):
    monkeypatch.setattr(nearest, "SAMPLE_ROWS", 320)  # 20 parents; 63 lists are wanted
    rng = np.random.default_rng(4)
    matrix = rng.standard_normal((40, 24))[rng.integers(0, 40, 4000)] + 0.6 * rng.standard_normal((4000, 24))
    matrix /= np.linalg.norm(matrix, axis=1).max()
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(matrix)], "id long, vec array<double>")
    lists = nearest.fit_lists(table, 4000, 1.0, 24)
    assert len(lists.parents) == 20 and 40 <= len(lists.centroids) <= 90 and lists.begins[-1] == len(lists.centroids)
    assert len(lists.begins) == 21 and (np.diff(lists.begins) >= 1).all()
    rotated = lists.rotated(matrix, False)
    own = {r.id: r.list for r in nearest.place(table, lists, 1, 1, False).collect()}
    assert len(own) == 4000
    for i, x in enumerate(rotated[:300]):
        parent = ((lists.parents - x) ** 2).sum(axis=1).argmin()
        a, b = lists.begins[parent:parent + 2]
        assert own[i] == a + ((lists.centroids[a:b] - x) ** 2).sum(axis=1).argmin()
    every = lists.order(rotated[:5], 20, len(lists.centroids))
    assert (np.sort(every, axis=1) == np.arange(len(lists.centroids))).all()
    far = ((lists.centroids[every] - rotated[:5, None]) ** 2).sum(axis=2)
    assert (np.diff(far, axis=1) >= -1e-9).all()
    some = lists.order(rotated[:5], 2, len(lists.centroids))  # the lists of two parents, then nothing
    assert all(((x >= 0) == (np.arange(len(x)) < (x >= 0).sum())).all() for x in some)

    hits, found = 0, {}
    for r in nearest.search(table, F.col("id") % 40 == 0, vec_id="id", vector="vec").collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    for q, near in found.items():
        scores = matrix @ matrix[q]
        scores[q] = -np.inf
        hits += len(near & set(np.argsort(-scores)[:20].tolist()))
    assert len(found) == 100 and hits / 2000 >= 0.9
