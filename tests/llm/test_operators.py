"""The operators against brute force, on awkward documents."""

import hashlib
import math
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash

from .conftest import TEXTS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- token counts ------------------------------------------------------------


def test_token_counts(docs, empty):
    import sentencepiece

    from turnstone.llm.token_counts import token_counts

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    want = sorted(((i, len((t or "").encode()), n := len(model.encode(t or "")), n > 50) for i, t in TEXTS), key=repr)
    assert rows(token_counts(docs, path, 50), "doc_id", "n_bytes", "n_tokens", "over_limit") == want
    assert token_counts(empty, path).count() == 0


def test_pre_tokens_add_up():
    import random

    from turnstone.llm.token_counts import _model, pieces_of, pre_tokens

    model, draw = _model(public_tokenizers.path("piece_bpe_32k.model")), random.Random(3)
    parts = [" ", "  ", "\n", "a", "the", "ing", "é", "▁", "▁▁", "日", ".", "\t", " ", "ﬁ"]
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 12)))
        assert pieces_of(model, pre_tokens(text)).sum() == len(model.encode(text)), repr(text)


# --- language ------------------------------------------------------------------


def test_language_id(docs, empty):
    from turnstone.llm.language_id import identify

    got = {(r["doc_id"], r["held_out"]): (r["lang_pred"], r["score"]) for r in identify(docs).collect()}
    for i, t in TEXTS:
        lang, score = got[i, i is not None and zlib.crc32(str(i).encode()) % 3 == 1]
        assert 0 <= score <= 1
        assert (lang == "und") == (not any(unicodedata.category(c)[0] == "L" for c in t or ""))
    assert identify(empty).count() == 0


def test_language_accuracy(spark):
    from pyspark.sql import functions as F

    from turnstone.llm.language_id import identify

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = identify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95


def test_pairs_decide_within_the_family():
    from turnstone.llm.language_id import Model, counts, features

    texts = {"en": "the cat and the dog of this house with that", "nl": "de kat en de hond van dit huis met dat", "es": "el gato y el perro de esta casa con que"}
    x = np.stack([features(counts(t, 1 << 12)) for t in texts.values()] * 3)
    model = Model(x, list(texts) * 3)
    assert model.families == ["germanic", "romance"] and model.pairs == [("en", "nl")]
    assert [model.predict(counts(t, 1 << 12))[0] for t in texts.values()] == list(texts)


# --- quality --------------------------------------------------------------------


def base(text):
    w = WORD.findall(text or "")
    grams = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    covered = {k + j for k in range(len(w) - 4) if grams[tuple(w[k : k + 5])] > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w)


def test_quality_rules(docs, empty):
    from turnstone.llm.quality import keep_good, quality_rules

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = quality_rules(docs)
    assert rows(got, "doc_id", *names) == sorted(((i, *base(t)) for i, t in TEXTS), key=repr)
    assert got.where("base_failed AND kept").count() == 0
    kept = keep_good(docs)
    assert kept.columns == docs.columns and {1, 2, 3, 15} <= {r["doc_id"] for r in kept.collect()}
    assert kept.where("doc_id IN (4, 5, 6, 10, 14)").count() == 0
    assert quality_rules(empty).count() == keep_good(empty).count() == 0
    plan = quality_rules(docs.sparkSession.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# --- transport streams -------------------------------------------------------------


def test_streams(docs, empty):
    from turnstone.llm.transport_stream import decode_streams, encode_streams, pad

    got = decode_streams(encode_streams(docs))
    want = []
    for i, t in TEXTS:
        raw = (t or "").encode()
        padded = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        assert pad(raw) == padded
        want.append((i, len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-32:])))
    assert rows(got, "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32") == sorted(want, key=repr)
    assert decode_streams(encode_streams(empty)).count() == 0


def test_stream_faults():
    from turnstone.llm.transport_stream import PACKET, StreamError, pad, read_stream, write_stream

    payload = pad(bytes(range(256)) * 20)
    data = write_stream(payload)
    got = read_stream(data)
    assert got.payload == payload and not got.continuity_errors and list(got.timestamps[:3]) == [0, 1080, 2160] and list(got.random_access) == [0]
    swapped = bytearray(data)
    swapped[6 * PACKET + 3] ^= 5
    assert read_stream(bytes(swapped)).continuity_errors
    packets = [data[k : k + PACKET] for k in range(0, len(data), PACKET)]
    joined = lambda x: read_stream(b"".join(x))
    # Unit u is packets 2 + 4u to 5 + 4u.  Sent twice, lost inside a unit, lost whole, lost with notice, begun late.
    twice = joined([*packets[:8], packets[7], *packets[8:]])
    assert twice.payload == payload and (twice.duplicates, twice.continuity_errors, twice.damaged) == (1, 0, 0)
    torn = joined(packets[:7] + packets[8:])
    assert torn.payload == payload[:576] + payload[2 * 576 :] and (torn.continuity_errors, torn.damaged) == (1, 1)
    assert list(torn.timestamps[:2]) == [0, 2160]
    gone = joined(packets[:6] + packets[10:])
    assert gone.payload == payload[:576] + payload[2 * 576 :] and (gone.continuity_errors, gone.damaged) == (1, 0)
    noted = bytearray(packets[10])
    noted[5] |= 0x80
    assert joined([*packets[:6], bytes(noted), *packets[11:]]).continuity_errors == 0
    late = joined(packets[:2] + packets[4:])
    assert late.payload == payload[576:] and late.damaged == 1
    # A table that begins in the middle of a section, and one whose checksum fails before a good one.
    middle = bytearray(packets[0])
    middle[1] &= 0xBF
    wrong = bytearray(packets[0])
    wrong[20] ^= 1
    for lead in (middle, wrong):
        assert joined([bytes(lead), *packets]).payload == payload
    for broken in (b"", data[:-1], b"\0" + data[1:], data[:20] + bytes([data[20] ^ 1]) + data[21:], data[: 2 * PACKET]):
        with pytest.raises(StreamError):
            read_stream(broken)


# --- packing -------------------------------------------------------------------------


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    from turnstone.llm.packing import pack_documents, piece_lengths

    path = public_tokenizers.path
    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    got = pack_documents(docs, path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, 256).collect()
    assert len({r["sequence_id"] for r in got}) == len(got) and all(r["offset"] == 0 for r in got)
    want = []
    for i, t in TEXTS:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        start = 0
        for n in piece_lengths(len(ids), 256):
            want.append((i, start, n, ids[start : start + n].tobytes(), len(ids)))
            start += n
        assert start == len(ids)
    assert sorted(((r["doc_id"], r["start"], r["length"], bytes(r["ids"]), r["doc_tokens"]) for r in got), key=repr) == sorted(want, key=repr)
    assert piece_lengths(2048 * 2 + 13, 2048) == [2048, 2048, 8, 4, 1]
    # Numbers go bucket by bucket, and a batch takes those of one bucket.
    assert all(r["sequence_id"] >> 57 == r["bucket"] and 1 << r["bucket"] == r["length"] for r in got)
    from turnstone.llm.packing import batch_of

    pieces = pack_documents(docs, path("byte_bpe_50k.json"), longest=256)
    own = sorted(r["sequence_id"] for r in got if r["length"] == 256)
    assert [r["length"] for r in batch_of(pieces, 8, 3, own[0]).collect()] == [256] * min(3, len(own) - 1)
    assert pack_documents(empty, path("byte_bpe_50k.json")).count() == 0


def test_fast_ids_are_the_tokenizer_s():
    import random

    from turnstone.llm.packing import encoder

    path, draw = public_tokenizers.path, random.Random(5)
    enc = encoder(path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    parts = [" ", "  ", "\n", "a", "b", "é", "1", ".", "'s", "\t", "日", " ", "ß", "²", "’", "<|endoftext|>", "\x85", " "]
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 14)))
        assert enc.encode(text) == enc.slow(text), repr(text)


# --- language model ----------------------------------------------------------------


def plain_scores(texts, spell, folds=5, fold=1):
    """The model in plain Python: (doc_id, held_out, n_tokens, n_known, base, score) of each text; ``spell`` gives a word's log10."""
    from turnstone.llm.context_mixing import END
    from turnstone.llm.lm_scoring import FORETOLD, FORETOLD_BITS, KNOWN, decision_tables, foretold_state, known_state
    from turnstone.llm.lm_scoring import word_hash as whole_hash

    def word_hash(w):
        return whole_hash(w) & FORETOLD_BITS

    held = [i is not None and zlib.crc32(str(i).encode()) % folds == fold for i, _ in texts]
    trains = [i is not None and not h for (i, _), h in zip(texts, held)]
    seqs = [[*(w.encode() for w in WORD.findall(lower(t))), END] for _, t in texts]
    own = [Counter(q) if t else Counter() for q, t in zip(seqs, trains)]
    pairs = [Counter(zip(q, q[1:], q[2:])) if t else Counter() for q, t in zip(seqs, trains)]
    count, after = Counter(), {}
    for c in own:
        count.update(c)
    for c in pairs:
        for (x, y, z), n in c.items():
            after.setdefault((x, y), Counter())[z] += n
    n_train, n_distinct = sum(count.values()), len(count)
    seen = np.zeros((FORETOLD + KNOWN, 2), np.int64)
    steps, fixed = [], []
    for d, q in enumerate(seqs):
        mine, run, told, total = [], 0, [2, 2], 0.0
        for k, w in enumerate(q):
            state = hit = None
            if k >= 2:
                key = (q[k - 2], q[k - 1])
                rest = {z: n - pairs[d][*key, z] for z, n in after.get(key, {}).items()}
                top = sorted(after.get(key, {}).items(), key=lambda x: (-x[1], word_hash(x[0])))[:2]
                top = sorted(((rest[z], word_hash(z)) for z, _ in top), key=lambda x: (-x[0], x[1]))
                if top and top[0][0] > 0:
                    state = int(foretold_state(np.array([run]), np.array([sum(rest.values())]), np.array([top[0][0]]))[0])
                    hit = word_hash(w) == top[0][1]
                    mine.append((state, int(hit)))
            left = count[w] - own[d][w]
            if not hit:
                state = FORETOLD + int(known_state(told[-1], told[-2], int(hit is False)))
                mine.append((state, int(left > 0)))
                total += math.log10(left / (n_train - sum(own[d].values()))) if left > 0 else spell(w)
            run = run + 1 if hit else 0
            told.append(int(left > 0))
        steps.append(mine)
        fixed.append(total)
        if trains[d]:
            for state, yes in mine:
                seen[state, yes] += 1
    yes = np.concatenate(decision_tables(seen))
    out = []
    for (i, _), h, q, mine, total in zip(texts, held, seqs, steps, fixed):
        base = sum(math.log10((count[w] + 0.5) / (n_train + 0.5 * (n_distinct + 1))) for w in q)
        out.append((i, h, len(q), sum(count[w] > 0 for w in q), n_train, base, total + sum(math.log10(yes[s] if y else 1 - yes[s]) for s, y in mine)))
    return out


def spelled_by(words, distinct):
    """log10 under the spelling model of these words, fitted here without Spark."""
    from turnstone.llm.context_mixing import Mixer, map_counts, maps_of, quantised, shape_for, slopes, slot_counts, stepped
    from turnstone.llm.context_mixing import GATES, ORDERS

    shape = shape_for(distinct)
    words = [w for w in words if w != b"\n"]
    from turnstone.llm.lm_scoring import MIN_BUCKETS as n_buckets

    buckets = [sorted(w for w in words if zlib.crc32(w) % n_buckets == k) for k in range(n_buckets)]
    zeros, ones = (np.zeros(shape.offsets[-1], np.int32) for _ in range(2))
    for own in filter(None, buckets):
        slot_counts(own, shape, zeros, ones)
    table = quantised(zeros, ones)
    weights, known, low = np.full((GATES, ORDERS), 0.3), np.zeros((GATES, ORDERS, ORDERS)), 0
    while low < n_buckets:
        high = min(n_buckets, max(1, 2 * low))
        sums = sum([slopes(Mixer(shape, table, weights), own, low < 4) for own in filter(None, buckets[low:high])], np.zeros(GATES * 27, np.int64))
        weights, known = stepped(weights, sums, known, None if low < 4 else high / low)
        low = high
    maps = [map_counts(Mixer(shape, table, weights), own) for own in filter(None, buckets)]
    n = shape.buckets * (256 + 4096)
    maps = maps_of(shape, sum([m[0] for m in maps], np.zeros(n, np.int64)), sum([m[1] for m in maps], np.zeros(n, np.int64)))
    mixer = Mixer(shape, table, weights, maps)
    return lambda w: float(np.float32(mixer.log10([w])[0]))


def same_scores(got, texts):
    held_by = Counter(w.encode() for i, t in texts if i is not None and zlib.crc32(str(i).encode()) % 5 != 1 for w in {*WORD.findall(lower(t)), "\n"})
    want = sorted(plain_scores(texts, spelled_by([w for w, n in held_by.items() if n == 1], len(held_by))), key=lambda r: (repr(r[0]), r[2], r[6]))
    for r, w in zip(sorted(got, key=lambda r: (repr(r["doc_id"]), r["n_tokens"], r["score"])), want, strict=True):
        assert (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:5]
        assert math.isclose(r["base_score"], w[5], rel_tol=1e-9) and math.isclose(r["score"], w[6], rel_tol=1e-9)


def test_lm_scoring(docs, empty):
    from turnstone.llm.lm_scoring import score

    got = score(docs).collect()
    same_scores(got, TEXTS)
    assert all(math.isclose(r["bits_per_byte"], -r["score"] * math.log2(10) / r["n_coded_bytes"]) for r in got)
    assert score(empty).count() == 0


def test_lm_scoring_without_training_texts(spark):
    from turnstone.llm.lm_scoring import score

    got = score(spark.createDataFrame([(None, "a b a b"), (None, None)], "doc_id long, text string")).collect()
    assert all(r["train_tokens"] == r["n_known"] == 0 and r["score"] < 0 for r in got)


def test_lm_scores_depend_on_the_corpus_alone(spark):
    from turnstone.llm.lm_scoring import score

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    first = None
    for parts in (1, 8, 64):
        got = score(docs.repartition(parts)).collect()
        scores = {r["doc_id"]: r["score"] for r in got}
        if first is None:
            first = scores
            same_scores(got, rows)
        assert all(math.isclose(scores[i], x, rel_tol=1e-9) for i, x in first.items())


def test_lm_beats_the_base_on_held_out_texts(spark):
    from pyspark.sql import functions as F

    from turnstone.llm.lm_scoring import score

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = score(docs).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > 0.95 * got[1]


def test_a_text_that_occurs_twice_is_foretold(spark):
    from turnstone.llm.lm_scoring import held_out, score

    draw, (a, b) = np.random.default_rng(1), [i for i in range(40) if not held_out(i)][:2]
    texts = [" ".join(f"w{x}" for x in draw.integers(0, 400, 200)) for _ in range(40)]
    got = {r["doc_id"]: r["score"] for r in score(spark.createDataFrame([(i, texts[a] if i == b else t) for i, t in enumerate(texts)], "doc_id long, text string")).collect()}
    assert min(got[a], got[b]) > 0.6 * np.mean([got[i] for i in range(40) if i not in (a, b)])


def test_spelling_is_a_distribution():
    from turnstone.llm.context_mixing import END, Mixer, Shape, map_counts, maps_of, quantised, slopes, slot_counts, stepped, GATES, ORDERS

    shape = Shape((8, 10, 12, 12, 12, 14))
    words = [b"the", b"then", b"there", b"of", b"other", b"often"]
    zeros, ones = (np.zeros(shape.offsets[-1], np.int64) for _ in range(2))
    slot_counts(words, shape, zeros, ones)
    table = quantised(zeros, ones)
    weights, known = np.full((GATES, ORDERS), 0.3), np.zeros((GATES, ORDERS, ORDERS))
    for _ in range(3):
        weights, known = stepped(weights, slopes(Mixer(shape, table, weights), words), known)
    mixer = Mixer(shape, table, weights, maps_of(shape, *map_counts(Mixer(shape, table, weights), words)))
    # All words of one letter and all that begin otherwise share what is left of one.
    singles = [bytes([b]) for b in range(256) if b not in (9, 10, 11, 12, 13, 32)]
    assert (10 ** mixer.log10([*singles, END])).sum() <= 1 + 1e-9
    assert mixer.log10([b"the"])[0] > mixer.log10([b"xqz"])[0]
    # Bit by bit, as single words and as a list, in plain numbers.
    assert np.allclose([mixer.log10([w])[0] for w in words], mixer.log10(words), rtol=1e-12)


# --- SimHash --------------------------------------------------------------------------


def simhash(text):
    w = WORD.findall(lower(text))
    grams = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs, empty):
    from turnstone.llm.simhash import near_duplicates

    prints = {}
    for i, t in TEXTS:
        prints.setdefault(simhash(t), []).append(i)
    groups = list(prints)
    parent = {f: f for f in groups}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a in groups:
        for b in groups:
            if (a ^ b).bit_count() <= 2:
                parent[root(a)] = root(b)
    least = {}
    for f, ids in prints.items():
        known = [i for i in ids if i is not None]
        least[root(f)] = min([*known, *([least[root(f)]] if least.get(root(f)) is not None else [])], default=None)
    want = sorted(((i, f"{simhash(t):016x}", least[root(simhash(t))]) for i, t in TEXTS), key=repr)
    assert rows(near_duplicates(docs), "doc_id", "fingerprint", "component_id") == want
    assert near_duplicates(empty).count() == 0


def test_unreadable_streams_are_told(spark):
    from turnstone.llm.transport_stream import decode_streams, pad, write_stream

    good = write_stream(pad(b"abc"))
    rows = decode_streams(spark.createDataFrame([(1, 3, bytearray(good)), (2, 3, bytearray(b"no stream"))], "doc_id long, n_bytes long, media binary")).orderBy("doc_id").collect()
    assert rows[0]["error"] is None and rows[0]["payload_bytes"] == 576
    assert rows[1]["error"] and rows[1]["payload_sha256"] is None


def test_equal_lengths_different_features():
    from turnstone.llm.transport_stream import feature_of, pad, read_stream, write_stream

    assert feature_of(read_stream(write_stream(pad(b"abc")))) != feature_of(read_stream(write_stream(pad(b"xyz"))))


@pytest.mark.parametrize("limit,radius", [(2, 2), (2048, 2), (3, 1), (2, 0), (4, 5)])
def test_links_lose_nothing(spark, limit, radius):
    from turnstone.llm._shared import Scratch
    from turnstone.llm.components import components
    from turnstone.llm.simhash import linked

    draw = np.random.default_rng(4)
    prints = set()
    for x in draw.integers(0, 1 << 63, 40).tolist():
        for _ in range(6):
            prints.add(x)
            x ^= 1 << int(draw.integers(64)) | 1 << int(draw.integers(64))
    prints = sorted(prints)
    parent = list(range(len(prints)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    want = Counter(root(k) for k in range(len(prints)))
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in prints], "fp long")
    scratch = Scratch(spark, "test")
    got = Counter(r["root"] for r in components(linked(df, scratch, radius, limit), scratch).collect())
    assert sorted(got.values()) == sorted(n for n in want.values() if n > 1)


def test_bk_tree_finds_all():
    from turnstone.llm.simhash import BKTree

    draw = np.random.default_rng(2)
    items = [int(x) & 0xFFF for x in draw.integers(0, 1 << 12, 300)]
    tree = BKTree()
    for x in items:
        tree.add(x)
    for q in range(0, 4096, 97):
        assert sorted(tree.items[k] for k in tree.within(q, 2)) == sorted(x for x in set(items) if (x ^ q).bit_count() <= 2)


# --- archives -----------------------------------------------------------------------------


def test_archives(spark):
    from turnstone.llm.warc import archived

    same = "<p>" + "same " * 40 + "</p>"
    pages = [(5, "http://a/ b", same, 1), (3, None, same, 1), (9, "u", same, 1), (1, "u", "short", 1), (2, "u", "short", 1), (4, "u", None, 1), (6, "u", "", 1), (7, "u", "long " * 20_000, 1), (None, "u", same, 1), (3, "u", same, 1)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, digest long")
    want = []
    for i, _, t, _ in pages:
        raw = (t or "").encode()
        back = len(raw) >= 100 and t == same and i != 3
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if back else "response", 3 if back else None))
    assert rows(archived(df), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(want, key=repr)
    assert archived(df.limit(0)).count() == 0


def test_archive_faults():
    from turnstone.llm.warc import ArchiveError, read_frames, read_record, write_archive, write_record

    records = [write_record(k, f"http://h/{k}", f"<html>{k} {'text ' * (k % 50)}</html>".encode(), None) for k in range(400)]
    data = write_archive(records)
    assert int.from_bytes(data[:4], "little") == 0x184D2A5D  # led by its dictionary
    assert [r for _, r in read_frames(data)] == records
    with pytest.raises(ArchiveError):
        list(read_frames(data[:-3]))
    with pytest.raises(ArchiveError):
        read_record(records[0].replace(b"<html>", b"<HTML>"))
    with pytest.raises(ArchiveError):
        read_record(records[0][:-1])


# --- mixing ----------------------------------------------------------------------------------


def test_mixing_meets_targets(spark):
    from pyspark.sql import functions as F

    from turnstone.llm.mixing import fit, mixed

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    got, report = fit(docs, labels)
    assert got.count() == docs.count() and got.where("rate < 0 OR rate IS NULL").count() == 0
    sums = got.agg(*[F.sum(F.col("n_tokens") * F.col(f"p_{d}") * F.col("rate")).alias(d) for d in ("clean", "rough", "toxic")]).first()
    total = sum(sums)
    assert report["converged"] and report["met"]
    assert abs(sums["clean"] / total - 0.95) < 0.005 and abs(sums["rough"] / total - 0.05) < 0.005 and sums["toxic"] / total < 0.005
    assert all(math.isclose(sums[c.removeprefix("p_")], x, rel_tol=1e-9) for c, x in report["reached"].items())
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    kept = mixed(docs, labels, {"clean": 1.0}, closeness=0.003).cache()
    assert kept.columns == docs.columns
    clean, toxic = labels.where("quality = 1 AND toxic = 0").select("doc_id"), labels.where("toxic = 1 AND quality = 1").select("doc_id")
    assert kept.join(clean, "doc_id", "left_semi").count() > 0.97 * clean.count()
    assert kept.join(toxic, "doc_id", "left_semi").count() < 0.05 * toxic.count()


def nonnegative_rates(tokens, p, aim, weight, rounds=200_000):
    """Rates r >= 0 of least |tokens p r - aim|^2 + weight tokens (r - 1)^2, by plain accelerated projected gradient."""
    a = tokens[:, None] * p
    scale = np.sqrt(tokens)
    m, pull = a / scale[:, None], weight  # in r * sqrt(tokens) the second term is a plain distance
    step = 1 / (np.linalg.norm(m.T @ m, 2) + pull)
    x = y = scale.copy()
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * (m @ (m.T @ y - aim) + pull * (y - scale)))
        after = (1 + math.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / after * (new - x)
        if np.abs(new - x).max() < 1e-10 * scale.max():
            x = new
            break
        x, t = new, after
    return x / scale


def test_rates_are_the_least_squares_solution(spark):
    from turnstone.llm.mixing import TARGETS, fitted

    draw = np.random.default_rng(3)
    tokens = draw.integers(1, 400, 150).astype(float)
    p = draw.dirichlet([0.3, 0.2, 0.1], 150)
    table = spark.createDataFrame([(int(n), *map(float, x)) for n, x in zip(tokens, p)], "n_tokens long, p_clean double, p_rough double, p_toxic double")
    for targets, closeness in ((TARGETS, 0.01), ({"clean": 0.2, "rough": 0.4, "toxic": 0.4}, 0.05), ({"toxic": 1.0}, 0.02)):
        rate, report = fitted(table, ["p_clean", "p_rough", "p_toxic"], targets, closeness=closeness)
        got = np.array([r[0] for r in table.select(rate).collect()])
        aim = np.array([report["aim"][f"p_{d}"] for d in ("clean", "rough", "toxic")])
        want = nonnegative_rates(tokens, p, aim, closeness * aim.sum())
        assert report["converged"] and np.abs(got - want).max() < 1e-3


def test_targets_out_of_reach_are_told(spark):
    from turnstone.llm.mixing import fitted

    table = spark.createDataFrame([(10, 0.5, 0.5)] * 5, "n_tokens long, p_clean double, p_toxic double")
    rate, report = fitted(table, ["p_clean", "p_toxic"], {"clean": 1.0})
    assert not report["met"] and report["converged"] and report["missed"] > 0.1


def test_mixing_edges(docs, empty, spark):
    from turnstone.llm.mixing import rates

    labels = spark.createDataFrame([(1, 1, 0, 9), (1, 1, 0, 9), (15, 1, 0, 9), (12, 0, 0, 9), (None, 1, 0, 9), (2, None, 0, 9)], "doc_id long, quality int, toxic int, text long")
    assert rates(docs, labels).count() == len(TEXTS)
    none = rates(docs, labels.limit(0))
    assert none.where("rate <> 1 OR p_all <> 1").count() == 0 and none.count() == len(TEXTS)
    assert rates(empty, labels).count() == 0


# --- substrings ----------------------------------------------------------------------------------


def removed(texts, window):
    first, words = {}, [(i, WORD.findall(t or "")) for i, t in texts]
    order = sorted(range(len(words)), key=lambda k: (words[k][0] is None, words[k][0] or 0, k))
    for k in order:
        w = words[k][1]
        for s in range(len(w) - window + 1):
            first.setdefault(tuple(w[s : s + window]), (k, s))
    out = []
    for k, (i, w) in enumerate(words):
        gone = {j for s in range(len(w) - window + 1) if first[tuple(w[s : s + window])] != (k, s) for j in range(s, s + window)}
        kept = [x for j, x in enumerate(w) if j not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_substrings(docs, empty):
    from turnstone.llm.recompression import deduplicate, repeats

    assert rows(repeats(docs, 20), "doc_id", "n_words", "n_removed", "kept_sha256") == removed(TEXTS, 20)
    left = deduplicate(docs, 20)
    assert left.columns == docs.columns and left.where("doc_id = 7").count() == 1
    assert repeats(empty, 20).count() == deduplicate(empty, 20).count() == 0


def test_no_repeat_is_lost(spark):
    from turnstone.llm.recompression import repeats

    draw = np.random.default_rng(7)
    texts = []
    for k in range(120):
        letters = "ab" if k % 3 else "abcd"
        parts = [" ".join(draw.choice(list(letters), int(draw.integers(1, 60))))]
        if texts and k % 2:
            other = texts[int(draw.integers(len(texts)))][1].split()
            at = int(draw.integers(len(other)))
            parts.append(" ".join(other[at : at + int(draw.integers(15, 40))]))
        texts.append((int(draw.integers(1000)) + 1000 * k, " ".join(parts)))
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    for window in (20, 8):
        assert rows(repeats(df, window), "doc_id", "n_words", "n_removed", "kept_sha256") == removed(texts, window)
