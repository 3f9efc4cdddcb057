"""The registered queries against plain versions of what they promise, and the pipeline's stages on odd rows."""

import base64
import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from shelfmatch.llm import language, quality
from shelfmatch.llm.queries import QUERIES
from tests.llm.test_models import brute_similarity
from tests.llm.test_texts import brute_components, brute_print

FOLDER = "/root/testdata/sf0.001"


def rows_of(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet").collect()


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def test_op1_ranks_and_scores(spark):
    vectors = {r.vec_id: np.array(r.embedding, dtype=float) for r in rows_of(spark, "embeddings")}
    found = defaultdict(list)
    for r in QUERIES["op1_ann_search"](spark, FOLDER).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert found.keys() == {v for v in vectors if v % 20 == 0}
    held = wanted = 0
    for query, rows in found.items():
        assert [r[0] for r in rows] == list(range(1, min(20, len(vectors) - 1) + 1)) and query not in {r[1] for r in rows}
        assert [r[2] for r in rows] == pytest.approx([float(vectors[query] @ vectors[v]) for _, v, _ in rows], abs=1e-12)
        assert [(-s, v) for _, v, s in rows] == sorted((-s, v) for _, v, s in rows)
        best = sorted((-float(vectors[query] @ x), v) for v, x in vectors.items() if v != query)[:20]
        held, wanted = held + len({v for _, v in best} & {r[1] for r in rows}), wanted + len(best)
    assert held / wanted >= 0.9


def test_op3_columns(spark):
    texts = {r.doc_id: (r.text or "").encode() for r in rows_of(spark, "documents")}
    found = QUERIES["op3_shard_documents"](spark, FOLDER).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in found} == {d: (len(t) + 1, zlib.crc32(t)) for d, t in texts.items()}
    assert {r.law for r in found} == {"bytes"} and {r.grown_shard for r in found} == {None}
    slots, sizes, shards = defaultdict(list), Counter(), defaultdict(set)
    for r in found:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
        shards[texts[r.doc_id]].add(r.shard)
    assert set(slots) == set(range(8)) and all(len(s) == 1 for s in shards.values())
    assert all(sorted(s) == list(range(min(s), min(s) + len(s))) and min(s) in (0, 1) for s in slots.values())
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r.size for r in found)


def plain_grams(text):
    """The 4-byte windows, one by one."""
    own = [b if b >= 128 or chr(b).isalpha() else 32 for b in text.lower().encode()]
    padded = [32, *own, 32]
    windows = [padded[i:i + 4] for i in range(len(padded) - 3)]
    return [int.from_bytes(bytes(w), "big") for w in windows if not any(a == b == 32 for a, b in zip(w, w[1:]))]


def test_op5_decisions(spark):
    docs = rows_of(spark, "documents")
    seen = defaultdict(Counter)
    for r in docs:
        if r.lang is not None and r.text is not None and crc(r.doc_id) % 5:
            seen[r.lang].update(plain_grams(r.text))
    shares = {name: {g: n / sum(c.values()) for g, n in c.items()} for name, c in seen.items()}
    common = {name: {g: s for g, s in own.items() if s >= language.LEAST_SHARE} for name, own in shares.items()}
    own = {name: {g for g, s in grams.items() if s >= language.LEAST_RATIO * max(c.get(g, 0) for c in common.values())} for name, grams in common.items()}
    found = {r.doc_id: r for r in QUERIES["op5_language_id"](spark, FOLDER).collect()}
    assert found.keys() == {r.doc_id for r in docs}
    right, apart = 0, []
    for r in docs:
        row, grams = found[r.doc_id], plain_grams(r.text or "")
        assert row.held_out == (crc(r.doc_id) % 5 == 0) and 0 <= row.score <= 1
        exact = {name: sum(g in held for g in grams) for name, held in own.items()}
        if max(exact.values(), default=0) == 0:
            continue
        best = max(exact, key=exact.get)
        right += row.lang_pred == best
        apart.append((len(grams), abs(row.score - exact[row.lang_pred] / sum(exact.values()))))
    assert right >= 0.98 * len(docs)
    # scores are as without false positives: on average, and for each text that is long enough for their rate to show
    assert np.mean([d for _, d in apart]) < 0.02 and max(d for n, d in apart if n >= 300) < 0.05


def test_counts_are_corrected_for_false_positives():
    """One n-gram after the other, against the whole filter at once."""
    rng = np.random.default_rng(3)
    size, names = 1 << 10, ["a", "b", "c"]
    slices = rng.integers(0, 8, size).astype(np.uint8)[None, :]
    chance = np.array([0.1, 0.3, 0.05])
    model = language.Model(names, slices, chance)
    text = "Zes wilde vogels, een oude boom 12; çà et là"
    grams = plain_grams(text)
    hits = [0, 0, 0]
    for gram in grams:
        at = [int(s[0]) for s in language.slots(np.array([gram], np.uint32), size)]
        for k in range(3):
            hits[k] += all(int(slices[0, i]) >> k & 1 for i in at)
    real = [max(0.0, (h - len(grams) * p) / (1 - p)) for h, p in zip(hits, chance)]
    best = real.index(max(real))
    assert model.predict(text) == pytest.approx((names[best], real[best] / sum(real), min(1.0, real[best] / len(grams))))


def test_op6_digests(spark):
    import public_tokenizers

    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.no_truncation()
    library.no_padding()
    expected = {}
    for r in rows_of(spark, "documents"):
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected[r.doc_id] = (len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), decoded)))
    found = QUERIES["op6_bpe"](spark, FOLDER).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found} == expected and len(found) == len(expected)


def test_op7_digits(spark):
    prints = {r.doc_id: brute_print(r.text or "") for r in rows_of(spark, "documents")}
    roots = brute_components(prints, 4)
    found = QUERIES["op7_simhash_dedup"](spark, FOLDER).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == {d: (f"{p % 2**64:016x}", roots[d]) for d, p in prints.items()}


def plain_statistics(text):
    """As named, letter by letter."""
    data = text.encode()
    if not data:
        return dict.fromkeys(quality.STATISTICS, 0.0)
    words, lines = data.split(), [line for line in data.split(b"\n") if line.strip()]
    n, n_words = len(data), max(1, len(words))

    def share(wanted):
        return sum(wanted(chr(b)) for b in data) / n

    marks, blanks = ".,;:!?'\"-()", "\t\n\v\f\r "
    return {
        "log_bytes": math.log(1 + n), "log_words": math.log(1 + len(words)), "word_length": sum(map(len, words)) / n_words,
        "longest_word": math.log(1 + max(map(len, words), default=0)), "upper_share": share(lambda c: "A" <= c <= "Z"),
        "digit_share": share(lambda c: "0" <= c <= "9"), "punctuation_share": share(lambda c: c in marks),
        "symbol_share": share(lambda c: ord(c) < 128 and not c.isalnum() and c not in marks + blanks),
        "blank_share": share(lambda c: c in blanks), "foreign_share": share(lambda c: ord(c) >= 128),
        "upper_words": sum(w.isupper() for w in words) / n_words, "plain_words": sum(w.isalpha() and w.islower() for w in words) / n_words,
        "distinct_words": len(set(words)) / n_words, "top_word": max((words.count(w) for w in set(words)), default=0) / n_words,
        "words_per_sentence": n_words / (1 + sum(chr(b) in ".!?" for b in data)), "words_per_line": n_words / max(1, len(lines)),
        "repeated_lines": 1 - len(set(lines)) / max(1, len(lines)), "stop_share": sum(len(w) <= 3 and w.isalpha() for w in words) / n_words,
        "lone_symbols": sum(len(w) == 1 and not w.isalnum() for w in words) / n_words,
    }


@pytest.mark.parametrize("text", ["", " \n\t", "A b C. d!", "één twee\n\nHET | 12 & the end\nthe end\nthe end", "\x00\x1f~ x,y;z\v(q)\r\n"])
def test_statistics_are_as_named(text):
    assert dict(zip(quality.STATISTICS, quality.statistics(text), strict=True)) == pytest.approx(plain_statistics(text))


def test_op8_scores_are_the_rules(spark, monkeypatch):
    models = []
    learn = quality.learn
    monkeypatch.setattr(quality, "learn", lambda *given, **more: models.append(learn(*given, **more)) or models[-1])
    found = {r.doc_id: r for r in QUERIES["op8_quality_rules"](spark, FOLDER).collect()}
    docs = rows_of(spark, "documents")
    assert found.keys() == {r.doc_id for r in docs} and len(models) == 1 and models[0].rules
    for r in docs:
        at, total = plain_statistics(r.text or ""), models[0].intercept
        for conditions, weight in models[0].rules:
            if all(at[name] <= bound if sign == "<=" else at[name] > bound for name, sign, bound in conditions):
                total += weight
        row = found[r.doc_id]
        assert row.score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-6)
        assert (row.held_out, row.predicted) == (crc(r.doc_id) % 3 == 1, int(row.score >= 0.5))


def test_op10_records(spark):
    payloads = {r.page_id: (r.html or "").encode() for r in rows_of(spark, "pages")}
    last = {}
    for page, payload in sorted(payloads.items()):
        last[payload] = page
    found = QUERIES["op10_warc"](spark, FOLDER).collect()
    assert len(found) == len(payloads) and {r.problem for r in found} == {None}
    for r in found:
        payload = payloads[r.page_id]
        first = last[payload]
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        record = ("response", None) if first == r.page_id else ("revisit", first)
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == (len(payload), digest, *record)


STAGES = dict(corpus_pipeline.STAGES)


def as_rows(frame):
    return sorted((tuple(r[c] for c in ("doc_id", "text", "position")) for r in frame.collect()), key=str)


def test_stages_of_no_rows(spark, documents):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents.limit(0), FOLDER).count() == 0, name


def test_stages_keep_all_columns(spark, documents):
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, documents, FOLDER)
        assert found.columns[:len(documents.columns)] == documents.columns, name
        assert found.where("n = 1 and `lines` = 2 and gone = 3 and id = 4 and found = 5 and bucket = 6 and `an odd.name` = 7").count() == found.count()


def test_language_stage_on_odd_rows(spark, documents):
    found = as_rows(STAGES["language_id"](spark, documents, FOLDER))
    assert {r[2] for r in found} >= {1, 2, 7, 8} and not {r[2] for r in found} & {3, 4, 5}  # null, empty and blank texts go
    assert sum(r[2] == 1 for r in found) == 2  # repeated rows stay together
    foreign = documents.limit(1).select(F.lit(99).cast("long").alias("doc_id"), F.lit("Съешь же ещё этих мягких французских булок").alias("text"), F.lit(None).cast("string").alias("lang"), *[F.col(f"`{c}`") for c in documents.columns[3:]])
    assert 99 not in {r[0] for r in as_rows(STAGES["language_id"](spark, documents.unionAll(foreign), FOLDER))}
    unknown = documents.withColumn("lang", F.lit(None).cast("string"))
    assert STAGES["language_id"](spark, unknown, FOLDER).count() == 0


def test_line_stage_on_odd_rows(spark, documents):
    wide = documents.withColumn("n_chars", F.char_length("text").cast("int")).withColumn("n_lines", F.lit(8)).withColumn("n_dropped", F.lit(9))
    found = {r.position: r for r in STAGES["line_dedup"](spark, wide, FOLDER).collect()}
    assert found[1].text == "alone one" and found[1].n_chars == 9  # the smaller id 3 keeps the shared line
    assert found[2].text.startswith("the same line") and found[6].text.startswith("The same line")  # without an id all lines stay
    assert found[3].text is None and found[3].n_chars is None and found[4].text == ""
    assert {(r.n_lines, r.n_dropped) for r in found.values()} == {(8, 9)}
    assert found[9].text == "Éa même LIGNE\nÉa même ligne"  # twice in one document
    assert len(found[7].text) > 300_000 and found[8].text == ""


def test_document_stage_on_odd_rows(spark, documents):
    found = as_rows(STAGES["simhash_dedup"](spark, documents, FOLDER))
    ids = {r[0] for r in found}
    assert 12 in ids and 13 not in ids  # equal texts: the smaller id stays
    assert 9 in ids and not {10, 11} & ids  # texts without words are one group


def test_decontamination_and_encoding_on_odd_rows(spark, documents):
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").first().text
    planted = documents.withColumn("text", F.when(F.col("position") == 2, F.concat(F.lit("voor "), F.lit(item), F.lit(" na"))).otherwise(F.col("text")))
    found = as_rows(STAGES["decontamination"](spark, planted, FOLDER))
    assert brute_similarity(f"voor {item} na", item) >= 0.8
    assert found == [r for r in as_rows(planted) if r[2] != 2]
    encoded = STAGES["bpe"](spark, documents.withColumn("ids", F.lit("old")), FOLDER)
    assert as_rows(encoded) == as_rows(documents)
    assert encoded.where("decoded <> coalesce(text, '') or ids is null").isEmpty()
    assert encoded.where("size(ids) = 0").count() == documents.where("coalesce(text, '') = ''").count()
