"""The text operators against brute force on small tables with nulls, empty, repeated, tied and long texts."""

import hashlib
import math
import random
import re
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import public_tokenizers
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import (divergence, huffman_ids, iblt, language_id, mixing, ngram_lm, packing, quality_classifier, queries,
                          shingles, simhash, suffix_dedup, tokens)
from millrace.session import stage
from tests.conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BPE = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, component_id long, _id long"


def texts():
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "Éa", "don't", "x,y", "the", "of", "and", "<|endoftext|>", "naïve", "123", "…."]
    out = [None, "", " \n\t ", "one", "a b c", "!!! ???"]
    for _ in range(40):
        out.append("\n".join(" ".join(rng.choices(words, k=rng.randint(1, 30))) + "." for _ in range(rng.randint(1, 6))))
    passage = " ".join(rng.choices(words, k=60))
    out += [f"{rng.random()} {passage} {rng.random()}" for _ in range(8)]
    out += [out[10]] * 5 + [" ".join(rng.choices(words, k=9000)), "ab" * 700, "Again " * 300]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3, t, ("en", "de", None)[i % 3], (None, "s1", "s1", "s2")[i % 4], None, 0.5, 1, 2) for i, t in enumerate(texts())]
    rows += [rows[12], (None, "no id here", "en", "s1", 1, 0.0, 0, 0)]
    return stage(spark.createDataFrame(rows, SCHEMA).repartition(3))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(docs):
    """(id with null first, text with null as empty), in order."""
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def test_language_model_counts_and_normalises(docs, empty):
    model = ngram_lm.train(docs)
    got = {r["doc_id"]: r for r in ngram_lm.score(docs, model, ("doc_id",)).collect()}
    tokens = {d: [*WORD.findall(lower(t)), "<end>"] for d, t in plain(docs)}
    every = [x for _, t in plain(docs) for x in [*WORD.findall(lower(t)), "<end>"]]
    count, n, v = Counter(every), len(every), len(set(every))
    pairs = Counter()
    for _, t in plain(docs):
        own = [*WORD.findall(lower(t)), "<end>"]
        pairs.update(zip(["<end>", *own], own))
    after = Counter(w for _, w in pairs)
    follow = {c: Counter(min(k, 3) for (a, _), k in pairs.items() if a == c) for c in count}

    def cut(k, d):
        return max(k - (0, *d)[min(k, 3)], 0)

    left = sum(k - cut(k, model.lower_discounts) for k in after.values())

    def p(context, word):
        low = (cut(after[word], model.lower_discounts) + left / (v + 1)) / len(pairs)
        if not count[context]:
            return low
        back = sum(model.discounts[i] * follow[context][i + 1] for i in range(3))
        return (cut(pairs[context, word], model.discounts) + back * low) / count[context]

    assert (model.tokens, model.distinct, model.bigrams) == (n, v, len(pairs))
    for context in ("the", "<end>", "…."):
        assert abs(sum(p(context, w) for w in count) + p(context, "unseen") - 1) < 1e-9
    for d, own in tokens.items():
        r = got[d]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), len(own), n)
        assert math.isclose(r["base_score"], sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own), rel_tol=1e-9)
        assert math.isclose(r["score"], sum(math.log10(p(a, b)) for a, b in zip(["<end>", *own], own)), rel_tol=1e-9)
    none = ngram_lm.train(empty)
    assert ngram_lm.score(docs, none, ("doc_id",)).where("score <> 0 or n_known > 0").count() == 0
    assert ngram_lm.score(empty, model).count() == 0


def in_order(frame):
    """(id, text) by id (null first), then by a hash of the text."""
    rows = frame.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text")).collect()
    return [(r["doc_id"], r["text"]) for r in sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["h"]))]


def paragraphs(t):
    return {p for p in re.split(r"\n|(?<=\.) ", t) if p}


def spelled(keys):
    return ",".join(sorted(f"{xxhash.xxh64(k.encode(), seed=42).intdigest():016x}" for k in keys))


def test_fingerprints(spark, docs, empty):
    def like(a, b):
        return round(len(a & b) / len(a | b) if a | b else 1.0, 12)

    rows, want = in_order(docs), []
    for i, (d, t) in enumerate(rows):
        after, k = rows[(i + 1) % len(rows)][1], len(t) // 2
        edited = t[:len(t) - k] + after[:k]
        a, e, x = map(paragraphs, (t, edited, after))
        want.append((str(d), len(t), hashlib.sha256(edited.encode()).hexdigest(), like(a, e), like(a, x), spelled(a - e), spelled(e - a)))
    got = iblt.compare(docs.withColumn("_place", F.lit(1)).withColumn("_t", F.lit("x"))).collect()
    assert sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"], round(r["near_edited"], 12), round(r["near_next"], 12),
                   r["removed_paragraphs"], r["added_paragraphs"]) for r in got) == sorted(want)
    text = {d: t for d, t in rows}
    prints = {(text[r["doc_id"]], r["fingerprint"]) for r in got if r["doc_id"] is not None}
    assert len(prints) == len({t for t, _ in prints})  # equal texts have equal fingerprints
    for r in got:
        assert (r["fingerprint"] == r["edited_fingerprint"]) == (not r["removed_paragraphs"] and not r["added_paragraphs"])
    assert iblt.compare(empty).count() == 0
    alone = iblt.compare(docs.where("doc_id = 0").limit(1)).first()
    assert alone["near_next"] == 1.0


@pytest.mark.parametrize("ranges,hot_rows", [(1, 1000), (4, 2), (30, 1)])
def test_next_rows_of_hot_ids(spark, ranges, hot_rows):
    rng = random.Random(3)
    rows = [(rng.choice([None, 7, 7, 7, rng.randint(1, 40)]), f"text {rng.randint(0, 60)}") for _ in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    own = in_order(frame)
    got = iblt.with_next(frame, "doc_id", ranges=ranges, hot_rows=hot_rows).select("doc_id", "text", "_next.text").collect()
    want = [(*row, own[(i + 1) % len(own)][1]) for i, row in enumerate(own)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_recovered_digests(spark):
    rng = random.Random(11)
    pairs = []
    for i, (common, ours, theirs, tables) in enumerate([(0, 0, 0, 1), (5, 0, 1, 1), (900, 3, 2, 1), (300, 0, 0, 1), (0, 400, 500, 2), (20, 3000, 10, 600), (0, 60, 0, 1)]):
        keys = [rng.getrandbits(64) - (1 << 63) for _ in range(common + ours + theirs)]
        pairs.append((i, keys[:common + ours], keys[:common] + keys[common + ours:], tables))
    frame = spark.createDataFrame(pairs, "pair long, ours array<long>, theirs array<long>, tables long").withColumn("whole", F.lit(True))
    got = {r["pair"]: (sorted(r["added"]), sorted(r["removed"])) for r in iblt.differences(frame).collect()}
    assert got == {i: (sorted({*a} - {*b}), sorted({*b} - {*a})) for i, a, b, _ in pairs}
    counted = {r["pair"]: (r["n_added"], r["added"]) for r in iblt.differences(frame.withColumn("whole", F.lit(False))).collect()}
    assert counted == {i: (len({*a} - {*b}), []) for i, a, b, _ in pairs}


def test_fingerprints_tell_how_many_differ(spark):
    rng = random.Random(12)
    ratios = []
    for n in (10, 100, 1000):
        for _ in range(10):
            keys = [rng.getrandbits(64) - (1 << 63) for _ in range(3 * n)]
            ratios.append((n, keys[:2 * n], keys[n:]))
    cells = iblt.subtract(*[iblt.sketch(iblt.entries(c, iblt.BASE, 0), iblt.BASE) for c in ("a", "b")])
    frame = spark.createDataFrame(ratios, "n long, a array<long>, b array<long>").selectExpr(f"{iblt.expected(cells, 'size(a)', 'size(b)')} / (2 * n) AS r")
    found = [r["r"] for r in frame.collect()]
    assert 0.75 < sum(found) / len(found) < 1.25


def brute_dedup(rows, length):
    seen, out = set(), []
    for d, t in rows:
        b, covered, end = t.encode(), bytearray(len(t.encode())), 0
        for i in range(len(b) - length + 1):
            if b[i:i + length] in seen:
                covered[max(i, end):i + length] = b"\1" * (i + length - max(i, end))
                end = i + length
            seen.add(b[i:i + length])
        out.append((d, len(b), sum(covered), bytes(c for c, m in zip(b, covered) if not m)))
    return out


@pytest.mark.parametrize("length,kmer,hot,piece", [(100, 32, 4096, 1 << 19), (30, 8, 3, 1 << 19), (30, 8, 4096, 500)])
def test_suffix_dedup(docs, empty, monkeypatch, length, kmer, hot, piece):
    monkeypatch.setattr(suffix_dedup.pieces, "__defaults__", (piece,))
    frame = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    got = {r["doc_id"]: r for r in suffix_dedup.dedup(frame, length=length, kmer=kmer, hot=hot).collect()}
    for d, n, removed, kept in brute_dedup(plain(frame), length):
        assert (got[d]["n_bytes"], got[d]["n_removed"], bytes(got[d]["kept"])) == (n, removed, kept), d
    twice = suffix_dedup.dedup(docs, length=length, kmer=kmer, hot=hot)
    assert twice.count() == docs.count() and suffix_dedup.dedup(empty).count() == 0


def test_simhash_groups(docs, empty):
    rows = plain(docs)

    def fingerprint(t):
        w = WORD.findall(lower(t))
        h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = [fingerprint(t) for _, t in rows]
    name = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(fps):
            for j, b in enumerate(fps):
                if (a ^ b).bit_count() <= 4:
                    name[i] = name[j] = min(name[i], name[j])
    least = {n: min((rows[i][0] for i in range(len(rows)) if name[i] == n and rows[i][0] is not None), default=None) for n in set(name)}
    want = Counter((rows[i][0], f"{fps[i]:016x}", least[name[i]]) for i in range(len(rows)))
    got = simhash.near_duplicates(docs, ("doc_id",))
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got.collect()) == want
    assert simhash.near_duplicates(empty, ("doc_id",)).count() == 0


def test_simhash_links_large_runs(monkeypatch):
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 2**63, 12, dtype=np.uint64)
    fps = np.unique(np.concatenate([c ^ (np.uint64(1) << rng.integers(0, 64, 60, dtype=np.uint64)) for c in centre] + [rng.integers(0, 2**63, 200, dtype=np.uint64)]))

    def parts(edges):
        up = {int(f): int(f) for f in fps}

        def root(x):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in edges:
            up[max(root(int(a)), root(int(b)))] = min(root(int(a)), root(int(b)))
        return [root(int(f)) for f in fps]

    every = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if int(a ^ b).bit_count() <= 4]
    for again in (20_000, 20):
        monkeypatch.setattr(simhash, "AGAIN_FROM", again)
        found = [x for a, b in simhash.run_links(np.zeros(len(fps), np.uint64), fps, 4, range(64)) for x in zip(a, b)]
        assert all(int(a ^ b).bit_count() <= 4 for a, b in found)
        assert parts(found) == parts(every)


def test_language_backs_off_to_shorter_grams(spark, docs, empty):
    train = spark.createDataFrame([("der hund und die katze", "de"), ("the dog and the cat", "en"), ("ohne sprache", None)], "text string, lang string")
    model = language_id.train(train)
    ask = spark.createDataFrame([(0, "the cat"), (1, "hunde katzen"), (2, None), (3, "123 ²!"), (4, "")], "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.predict(ask, model).collect()}
    assert [got[i][0] for i in range(5)] == ["en", "de", "und", "und", "und"] and got[2][1] == 0 and 0.5 <= got[0][1] <= 1
    logs = language_id.word_logs(["the", "hunde"], model)
    total = model.totals[0][1]
    assert math.isclose(logs[0][1], math.log(2.5 / (total + 0.5 * (model.distinct[0] + 1))))
    assert {r["lang_pred"] for r in language_id.predict(docs, language_id.train(empty)).collect()} == {"und"}


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    quality = queries.QUERIES["op1_quality_classifier"](spark, SF).where("held_out").join(labels, "doc_id")
    assert quality.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0] > 0.9
    lang = queries.QUERIES["op5_language_id"](spark, SF).where("held_out").join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id")
    assert lang.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] > 0.95


def test_classifier_without_usable_labels(docs, empty, spark):
    labels = spark.createDataFrame([(0, None), (None, 1)], "doc_id long, quality int")
    assert {r["score"] for r in quality_classifier.classify(docs, labels).collect()} == {0.5}
    assert quality_classifier.classify(empty, labels).count() == 0


def test_quality_rules(docs, empty):
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in divergence.judge(docs).collect())
    want = Counter()
    for d, t in plain(docs):
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        n = Counter(grams)
        covered = {i + j for i, g in enumerate(grams) if n[g] > 1 for j in range(3)}
        want[d, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)] += 1
    assert got == want and divergence.judge(empty).count() == 0


def test_mix(docs, empty):
    out = mixing.mix(docs, ("doc_id", "source"), slice_rows=2, fill=5).collect()
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix(docs, ("doc_id", "source"), slice_rows=2, fill=5).collect()))
    assert len(out) == docs.count()
    for source in {r["source"] for r in out}:
        own = [r for r in out if r["source"] == source]
        assert own[0]["target"] <= 3 * own[0]["source_size"] and all(r["taken"] <= 3 * r["size"] for r in own)
        assert 0 <= own[0]["target"] - sum(r["taken"] for r in own) <= max(r["size"] for r in own)
    assert sum({r["source"]: r["target"] for r in out}.values()) == pytest.approx(sum(r["size"] for r in out))
    assert mixing.mix(empty, ("doc_id",)).count() == 0


def ids_of(text, end):
    return [*Tokenizer.from_file(BPE).encode(text, add_special_tokens=False).ids, end]


def test_token_files(spark, docs, empty):
    folder = huffman_ids.write_files(docs, BPE, section=500, block=64)
    got = sorted(((r["key"], r["start"], r["n_tokens"], bytes(r["ids"])) for r in huffman_ids.read_files(spark, folder).collect()), key=lambda r: r[1])
    assert [r[1] for r in got] == list(np.cumsum([0, *(r[2] for r in got)])[:-1])
    assert [r[0] for r in got] == [d for d, _ in plain(docs)]
    want = Counter((d, np.array(ids_of(t, 2), "<u4").tobytes()) for d, t in plain(docs))
    assert Counter((r[0], r[3]) for r in got) == want
    assert huffman_ids.read_files(spark, huffman_ids.write_files(empty, BPE)).count() == 0


def test_code_lengths_are_best_and_limited():
    rng = random.Random(1)
    for n, limit in ((1, 4), (2, 4), (9, 4), (16, 4), (300, 9)):
        counts = np.array([int(1.6 ** min(i, 40)) + rng.randint(0, 3) for i in range(n)] + [0])
        lengths = huffman_ids.code_lengths(counts, limit)
        used = lengths[:n].astype(float)
        assert lengths[n] == 0 and used.max() <= limit and (2.0 ** -used).sum() <= 1
        code = huffman_ids.Code.of(lengths)
        ids = np.array(rng.choices(range(n), k=5000), np.uint32)
        words, offsets = code.encode(ids, 100)
        assert (code.decode(words, offsets, len(ids), 100) == ids).all()


def test_packing(docs, empty):
    rows = packing.pack(docs.where("doc_id is not null").dropDuplicates(["doc_id"]), BPE, ("doc_id",), block_ids=4000).collect()
    want = {d: ids_of(t, 1) for d, t in plain(docs) if d is not None}
    by_doc, by_window = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_window.setdefault(r["sequence_id"], []).append(r)
    for d, ids in want.items():
        own = sorted(by_doc[d], key=lambda r: r["start"])
        assert np.frombuffer(b"".join(r["ids"] for r in own), "<u4").tolist() == ids
        assert [r["start"] for r in own] == list(np.cumsum([0, *(r["length"] for r in own)])[:-1]) and own[0]["doc_tokens"] == len(ids)
    for own in by_window.values():
        own.sort(key=lambda r: r["offset"])
        used = sum(r["length"] for r in own)
        assert [r["offset"] for r in own] == list(np.cumsum([0, *(r["length"] for r in own)])[:-1])
        assert used <= own[0]["window"] and (used == own[0]["window"] or own[0]["window"] == 2048)
    assert packing.pack(empty, BPE).count() == 0


def test_a_packing_worker_holds_little():
    """Of 200,000 different words, and of a block beside its ids."""
    dealt = np.random.default_rng(1).integers(97, 123, (200_000, 9)).astype(np.uint8)
    dealt[:, 8] = 32
    texts = pa.array([dealt[i:i + 1000].tobytes().decode() for i in range(0, len(dealt), 1000)])
    coder = tokens.encoder(BPE)
    coder._clear()
    tracemalloc.start()
    try:
        held = [(ids, at, [pa.array(range(lo, hi))]) for lo, hi, ids, at in tokens.encoded(texts, BPE, 1)]
        ids = np.concatenate([x for x, _, _ in held])
        assert tracemalloc.get_traced_memory()[1] < 70e6
        tracemalloc.reset_peak()
        before = tracemalloc.get_traced_memory()[0]
        block = packing._packed(held, [SimpleNamespace(name="row")], {"windows": 0, "groups": 0}, packing.SIZES, packing.STEP)
        assert tracemalloc.get_traced_memory()[1] - before < 2 * ids.nbytes
    finally:
        tracemalloc.stop()
    first = np.cumsum([0, *np.concatenate([np.diff(at) for _, at, _ in held])])
    assert len(held) > 1 and len(coder.keys) == len(np.unique(dealt[:, :8], axis=0)) and ids[:first[1]].tolist() == ids_of(texts[0].as_py(), 1)
    for r in block.to_pylist():
        at = first[r["row"]] + r["row_start"]
        assert r["ids"] == ids[at:at + r["length"]].astype("<u4").tobytes()
    assert sum(block["length"].to_pylist()) == len(ids)


def test_packing_pads_little():
    rng = random.Random(2)
    windows = packing.plan([int(rng.lognormvariate(6.5, 1)) + 1 for _ in range(3000)])
    used = sum(n for _, pieces in windows for _, _, n in pieces)
    assert used / sum(size for size, _ in windows) > 0.99
    groups = packing.step_groups(windows)
    sizes = Counter(groups)
    assert max(sizes.values()) - min(sizes.values()) <= 1


def test_pipeline_stages(spark, docs, empty):
    rows = stage(docs.select(*corpus_pipeline.COLUMNS))
    kept = stage(corpus_pipeline.drop_near_duplicates(spark, rows, SF))
    groups = simhash.near_duplicates(rows, ("doc_id",)).select("root").distinct().count()
    assert kept.count() == groups
    rest = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_repeated_passages(spark, kept, SF).collect()}
    for d, _, _, left in brute_dedup(plain(kept), 100):
        assert (rest[d] or "") == left.decode("utf-8", "ignore")
    mixed = Counter(r["doc_id"] for r in corpus_pipeline.mix_sources(spark, kept, SF).collect())
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(kept, ("doc_id",), preference=F.log2(1 + mixing.n_words())).collect()}
    assert mixed == Counter({d: n for d, n in copies.items() if n})
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, empty.select(*corpus_pipeline.COLUMNS), SF)
        assert out.count() == 0 and (name == "packing" or out.columns == list(corpus_pipeline.COLUMNS))


def test_pipeline_rejects_what_the_classifier_rejects(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.keep_quality(spark, docs, SF).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert sum((d in kept) == bool(q) for d, q in labels.items()) > 0.95 * len(labels)


def jaccard_roots(texts):
    """Index of the first text that each is connected with by five-word shingle sets of similarity 0.8 or more."""
    sets = []
    for t in texts:
        w = WORD.findall(lower(t or ""))
        sets.append({" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    name = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 5 * len(a & b) >= 4 * len(a | b) > 0:
                old, new = max(name[i], name[j]), min(name[i], name[j])
                name = [new if n == old else n for n in name]
    return name


@pytest.mark.parametrize("block", [256, 8])
def test_near_duplicates_by_five_word_shingles(spark, block):
    rng = random.Random(8)
    common = " ".join(f"c{i}" for i in range(30))
    out = [None, "", " ", "one two", "One  two", "one two three"]
    for _ in range(25):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(20, 150))]
        out.append(" ".join(base) + " " + common)
        for _ in range(4):  # similarities on both sides of 0.8
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
            out.append(" ".join(w) + " " + common)
    base = [f"h{i}" for i in range(120)]
    for _ in range(60):  # one large group, of which only some are similar to each other
        w = list(base)
        for i in rng.sample(range(120), rng.randint(1, 5)):
            w[i] = f"y{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    rows = spark.createDataFrame(list(enumerate(out)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["root"] for r in shingles.near_duplicates(rows, ("doc_id",), block=block).collect()}
    want = jaccard_roots(out)
    parts = [{frozenset(i for i in range(len(out)) if name[i] == n) for n in set(name)} for name in ([got[i] for i in range(len(out))], want)]
    assert parts[0] == parts[1] and len(parts[1]) < len(out)


def near_copies(rng):
    out = []
    for _ in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(60, 300))]
        for changed in (0, 1, 1, 2, 6, 9):
            w = list(base)
            for _ in range(changed):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
            out.append(" ".join(w))
    return out


@pytest.mark.parametrize("segments", [3, 4])
def test_simhash_links_what_is_near_in_bits_and_similar_in_shingles(spark, monkeypatch, segments):
    monkeypatch.setattr(shingles, "SEGMENTS", ((None, segments),))
    docs = spark.createDataFrame(list(enumerate(near_copies(random.Random(4)))), "doc_id long, text string").repartition(3)
    sets = shingles.sets_with_entries(docs)
    nodes = {r["node"]: (r["fp"] % 2**64, set(np.frombuffer(r["shingles"], np.uint64).tolist())) for r in sets.collect()}
    for fp, own in nodes.values():
        assert fp == sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in own) > len(own))

    def alike(x, y):
        return 5 * len(x & y) >= 4 * len(x | y)

    name = {n: n for n in nodes}
    found = [(r["a"], r["b"]) for r in shingles.by_fingerprint(sets).collect()]
    for a, b in found:
        assert alike(nodes[a][1], nodes[b][1])
        old, new = name[a], name[b]
        name = {n: new if m == old else m for n, m in name.items()}
    near = [(a, b) for a in nodes for b in nodes if a < b and (nodes[a][0] ^ nodes[b][0]).bit_count() <= shingles.DISTANCE and alike(nodes[a][1], nodes[b][1])]
    assert len(near) > 20 and all(name[a] == name[b] for a, b in near)


def test_a_block_without_links_names_its_sets_exactly():
    rng = np.random.default_rng(1)
    nodes = rng.integers(-2**63, 2**63, 5)
    rows = pd.DataFrame({"root": nodes[0], "node": nodes, "class": nodes, "shingles": [rng.bytes(400) for _ in nodes], "blocks": 2})
    far = shingles._compare(rows)
    assert far["a"].tolist() == far["b"].tolist() == nodes[1:].tolist()


def test_pipeline_drops_near_duplicates_by_simhash_first(spark, monkeypatch):
    """Of what SimHash connects no set is compared again, and what it misses is still found."""
    texts = near_copies(random.Random(4))
    rows = [(i, t, "en", "s1", len(t)) for i, t in enumerate(texts)]
    asked, dealt, links, in_blocks = [], [], simhash.links, shingles._in_blocks
    monkeypatch.setattr(simhash, "links", lambda fps, *a: asked.append((fps.count(), a)) or links(fps, *a))
    monkeypatch.setattr(shingles, "_in_blocks", lambda rows, far: dealt.append((far, rows.count())) or in_blocks(rows, far))
    kept = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, SCHEMA.split(", score")[0]).repartition(4), SF)
    assert {r["doc_id"] for r in kept.collect()} == set(jaccard_roots(texts))
    assert [a for _, a in asked] == [(shingles.DISTANCE, 4)] and asked[0][0] > 40
    assert [far for far, _ in dealt] == [False, True] and dealt[1][1] < asked[0][0]


def test_pipeline_drops_near_copies_of_five_word_similarity(spark):
    rows = [r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(*corpus_pipeline.COLUMNS).collect()]
    kept = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, SCHEMA.split(", score")[0]).repartition(4), SF)
    own = {}
    texts_of = {r["doc_id"]: r["text"] for r in rows}
    ids = sorted(texts_of)
    for i, name in zip(ids, jaccard_roots([texts_of[i] for i in ids])):
        own.setdefault(name, i)
    assert {r["doc_id"] for r in kept.collect()} == set(own.values())


@pytest.mark.parametrize("length,kmer,hot,piece", [(100, 32, 4096, 1 << 19), (30, 8, 3, 1 << 19), (30, 8, 4096, 500)])
def test_suffix_dedup_keeps_rows_of_equal_id_and_text(spark, docs, monkeypatch, length, kmer, hot, piece):
    monkeypatch.setattr(suffix_dedup.pieces, "__defaults__", (piece,))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    alone = " ".join(f"u{i}" for i in range(200))
    rows += [(None, alone)] * 3 + [(7_000, alone + " end")] * 2 + [(-5, "v" + alone[::-1])] * 2
    frame = spark.createDataFrame([*rows, *rows[20:40]], "doc_id long, text string").repartition(5)
    order = sorted({(d, t or "") for d, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0, xxhash.xxh64_intdigest(r[1].encode())))
    want = {(d, t): (removed, kept) for (d, t), (_, _, removed, kept) in zip(order, brute_dedup(order, length))}
    got = suffix_dedup.dedup(frame, ("doc_id", "text"), length=length, kmer=kmer, hot=hot).collect()
    assert len(got) == frame.count() and want[None, alone][0] == want[-5, "v" + alone[::-1]][0] == 0
    for r in got:
        assert (r["n_removed"], bytes(r["kept"])) == want[r["doc_id"], r["text"] or ""], r["doc_id"]


def test_mix_tries_all_later_documents(spark):
    rows = [(i, "w " * 20, "long") for i in range(1500)] + [(-1, "w " * 24_000, "long")]
    rows += [(10_000 + i, "w " * rng_size, "mixed") for i, rng_size in enumerate(random.Random(4).choices([1, 3, 50, 700, 9000], k=600))]
    rows += [(20_000 + i, "w " * 30, "plain") for i in range(2500)] + [(30_000, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    for fill, slice_rows, seed in ((200, 100_000, "mix"), (1, 4, "a"), (7, 100_000, "b"), (200, 100_000, "c")):
        got = mixing.mix(frame, ("doc_id", "source"), fill=fill, slice_rows=slice_rows, seed=seed).collect()
        assert len(got) == len(rows)
        for source in ("long", "mixed", "plain"):
            own = [r for r in got if r["source"] == source]
            words, target = own[0]["source_size"], own[0]["target"]
            whole, left = int(target // words), target - target // words * words
            chance = min(max(left / words * words / (words * 1.0), 1e-6), 1 - 1e-6)

            def rank(r):
                u = (int(hashlib.md5(f"{seed}:{r['doc_id']}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
                return u / (1 - u) * ((1 - chance) / chance), r["doc_id"], r["size"]

            for r in sorted(own, key=rank):
                fits = r["size"] <= left
                left -= r["size"] * fits
                assert r["copies"] == whole + fits, (source, r)
            assert target - sum(r["taken"] for r in own) == pytest.approx(left)
