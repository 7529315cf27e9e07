"""Alignment, packing and periodic runs against the libraries themselves and plain Python."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from checks.verify import connect, rows_of
from repopulse.llm import crosswalk, packing, periodic_runs, subwords
from repopulse.llm.oracles import ORACLES
from repopulse.llm.queries import QUERIES, with_planted_runs
from repopulse.llm.words import text_buffer

from . import odd
from .test_operators import words

BYTE, PIECE = (subwords.default_vocabulary(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def docs(spark):
    return odd.frame(spark).cache()


@pytest.fixture(scope="module")
def none(spark):
    return odd.frame(spark, [])


@pytest.fixture(scope="module")
def plain():
    """The libraries' own answers: ids with and without special tokens, and pieces."""
    special, literal = Tokenizer.from_file(BYTE), Tokenizer.from_file(BYTE)
    literal.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    return (lambda t: special.encode(t, add_special_tokens=False).ids, lambda t: literal.encode(t, add_special_tokens=False).ids, pieces.encode)


def odd_texts(seed):
    rng = random.Random(seed)
    parts = [*"aab  the ing\n\n\t\r'sdll123.,!<|>éßл漢", "\xa0", " ", "　", "\x85", "\x1c", "\x00", "▁", "<|endoftext|>", " the", "  ", "<s>", "😀", "\r\n", ";\r"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    return [*made, "", None, "a" * 5000, " " * 3000, "x " * 4000, *[r[1] for r in odd.rows()]]


def split(ids, counts):
    ends = np.cumsum(counts)
    return [ids[b - n : b].tolist() for b, n in zip(ends, counts, strict=True)]


def test_segments_give_the_ids_of_whole_texts(plain):
    texts = odd_texts(1)
    data, offsets = text_buffer(pa.array(texts, pa.string()))
    ids, counts, good = subwords.ByteBpe.load(BYTE).encode(data, offsets)
    assert good.all() and split(ids, counts) == [plain[0](t or "") for t in texts]
    spaced = subwords.with_leading_space(data, offsets)
    ids, counts, good = subwords.ByteBpe.load(BYTE, plain_specials=True).encode(*spaced)
    assert good.all() and split(ids, counts) == [plain[1](" " + (t or "")) for t in texts]
    side = subwords.PieceBpe.load(PIECE)
    ids, counts, good = side.encode(*spaced)
    for text, got, ok in zip(texts, split(ids, counts), good, strict=True):
        want = plain[2](text or "")
        same = b"".join(side.token_bytes[i] for i in want) == (" " + (text or "")).encode()
        if text:
            assert ok == same and (not ok or got == want), text


def test_segments_of_no_texts():
    for side in (subwords.ByteBpe.load(BYTE), subwords.PieceBpe.load(PIECE)):
        for n in (0, 3):
            ids, counts, good = side.encode(np.zeros(0, np.uint8), np.zeros(n + 1, np.int64))
            assert len(ids) == 0 and counts.tolist() == [0] * n and good.all()


def aligned_by_hand(text, plain):
    """(n_a, n_b, groups as text, links) of one text."""
    a, b = plain[1](" " + text) if text else [], plain[2](text) if text else []
    sides = subwords.ByteBpe.load(BYTE, plain_specials=True).token_bytes, subwords.PieceBpe.load(PIECE).token_bytes
    bytes_of = [[side[i] for i in ids] for side, ids in zip(sides, (a, b), strict=True)]
    if not text or any(b"".join(x) != (" " + text).encode() for x in bytes_of):
        return 0, 0, "", []
    ends = [np.cumsum([len(t) for t in x]).tolist() for x in bytes_of]
    groups, i, j = [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        x, y = ends[0].index(end) + 1, ends[1].index(end) + 1
        groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
        i, j = x, y
    links = [(p, q) for p, s, e in zip(a, [0, *ends[0]], ends[0], strict=False) for q, t, f in zip(b, [0, *ends[1]], ends[1], strict=False) if s < f and t < e]
    return len(a), len(b), ";".join(groups), links


def test_alignment_of_odd_rows(docs, plain):
    short = docs.where("text IS NULL OR length(text) < 4000")
    rows = [(r.doc_id, aligned_by_hand(r.text, plain)) for r in short.collect()]
    counts = Counter(link for _, (*_, links) in rows for link in set(links))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    want = Counter((i, n_a, n_b, groups.count(";") + 1 if groups else 0, len(links), sum(counts[x] == best[x[0]] for x in links),
                    sum(counts[x] for x in links), groups) for i, (n_a, n_b, groups, links) in rows)
    assert Counter(map(tuple, crosswalk.aligned(short).collect())) == want
    hashed = Counter((*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[7] else "") for r in want.elements())
    assert Counter(map(tuple, crosswalk.aligned(short, keep_text=False).collect())) == hashed


def test_alignment_counts_across_blocks(spark, plain):
    """Pairs of ids are counted over all blocks, each a task of its own."""
    texts = ["the cat sat", "the cat", "a cat's hat", "the the the"] * 5
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    counts = Counter(link for t in texts for link in set(aligned_by_hand(t, plain)[3]))
    got = {r.doc_id: r.count_sum for r in crosswalk.aligned(frame).collect()}
    assert got == {i: sum(counts[x] for x in aligned_by_hand(t, plain)[3]) for i, t in enumerate(texts)}


def test_alignment_of_nothing(none):
    assert crosswalk.aligned(none).collect() == []


def ids_of(piece):
    return np.frombuffer(piece.ids, "<u4").tolist()


def check_packed(pieces, rows, plain, window):
    """Every id once, sequences without gaps, nothing padded; gives the sequences."""
    texts = {}
    for r in rows:
        texts.setdefault(r[0], []).append([*plain[0](r[1] or ""), packing.END])
    covered = Counter()
    for p in pieces:
        ids = ids_of(p)
        assert p.length == len(ids) > 0
        assert any(len(t) == p.doc_tokens and t[p.start : p.start + p.length] == ids for t in texts[p.doc_id])
        covered.update((p.doc_id, p.doc_tokens, p.start + k) for k in range(p.length))
    assert covered == Counter((i, len(t), k) for i, ts in texts.items() for t in ts for k in range(len(t)))
    sequences = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        own = sequences.setdefault(p.sequence_id, [])
        assert p.offset == len(own)
        own += ids_of(p)
    assert sorted(sequences) == list(range(len(sequences)))
    assert all(len(s) == window or len(s) < window and len(s) & (len(s) - 1) == 0 for s in sequences.values())
    return sequences


@pytest.mark.parametrize("chunk_tokens", [1 << 20, 5000])
def test_packing_of_odd_rows(docs, plain, chunk_tokens):
    packed = packing.pack(docs, window=256, chunk_tokens=chunk_tokens, least_piece=16)
    sequences = check_packed(packed.collect(), docs.select("doc_id", "text").collect(), plain, 256)
    got = {r.sequence_id: (r.n_tokens, ids_of(r)) for r in packing.assemble(packed).collect()}
    assert got == {k: (len(v), v) for k, v in sequences.items()}


def test_packing_without_rows_or_sources(none, docs, plain):
    assert packing.pack(none).collect() == []
    few = docs.select("doc_id", "text").limit(12)
    rows = [tuple(r) for r in few.collect()]
    pieces = packing.pack(few.sparkSession.createDataFrame(rows, "doc_id long, text string"), window=64).collect()
    check_packed(pieces, rows, plain, 64)
    assert {p.source for p in pieces} == {None}


def sources(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["one", "two", "three"]) for _ in range(rng.randrange(1, 300))), "big" if i % 3 else f"s{i % 5}") for i in range(300)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)


def shares(pieces):
    return {k: Counter(p.source for p in pieces if p.sequence_id == k for _ in range(p.length))
            for k in {p.sequence_id for p in pieces}}


def test_sequences_follow_the_corpus(spark, plain):
    rows, frame = sources(spark)
    pieces = packing.pack(frame, window=512, chunk_tokens=3000, least_piece=8).collect()
    check_packed(pieces, rows, plain, 512)
    every = Counter()
    for p in pieces:
        every[p.source] += p.length
    total = sum(every.values())
    per_sequence = shares(pieces)
    for k in range(total // 512):
        for s, n in every.items():
            assert abs(per_sequence[k][s] - 512 * n / total) <= 2 * len(every) + 16, (k, s)
    # the account never runs away: after any number of sequences a source is within a few tokens of its due
    run = Counter()
    for k in range(total // 512):
        run.update(per_sequence[k])
        assert all(abs(run[s] - 512 * (k + 1) * n / total) <= 2 * len(every) + 16 for s, n in every.items())


def test_sequences_follow_given_weights(spark, plain):
    rows, frame = sources(spark)
    weights = {"big": 1.0, **{f"s{i}": 0.25 for i in range(5)}}
    pieces = packing.pack(frame, weights, window=256, chunk_tokens=2000, least_piece=8).collect()
    check_packed(pieces, rows, plain, 256)
    per_sequence = shares(pieces)
    assert all(abs(per_sequence[k]["big"] - 256 / 2.25) <= 30 for k in range(20))
    with pytest.raises(ValueError, match="above 0"):
        packing.pack(frame, {"big": 0.0})


def test_schedule_gives_every_token_to_one_chunk():
    rng = np.random.default_rng(0)
    for _ in range(50):
        totals = rng.integers(1, 5000, rng.integers(1, 9))
        weights = totals if rng.random() < 0.5 else rng.random(len(totals)) + 0.01
        plan = packing.Schedule(totals, weights, int(rng.integers(1, 40)))
        taken = np.zeros((len(totals), plan.chunks), np.int64)
        for s, n in enumerate(totals):
            np.add.at(taken[s], plan.chunk_of(np.full(n, s), np.arange(n)), 1)
        position = 0
        for k in range(plan.chunks):
            begin, tokens, deficits = plan.chunk(k)
            assert begin == position and tokens.tolist() == taken[:, k].tolist()
            assert (deficits >= 0).all() and (deficits < 1).all()
            position += tokens.sum()


def runs_by_hand(own):
    stretches = []
    for q in range(1, len(own) // 4 + 1):
        i = 0
        while i < len(own) - q:
            start = i
            while i < len(own) - q and own[i] == own[i + q]:
                i += 1
            if i + q - start >= max(6, 4 * q):
                stretches.append((start, i + q, q))
            i += i == start
    return sorted((s, e - s, q) for s, e, q in stretches if not any(p < q and a <= s and b >= e for a, b, p in stretches))


def test_runs_against_every_period():
    rng = random.Random(5)
    for _ in range(300):
        docs = []
        for _ in range(rng.randint(0, 6)):
            n, k = rng.choice([0, 1, 3, 7, 20, 60, 130]), rng.choice([1, 2, 3, 10])
            own = [rng.randrange(k) for _ in range(n)]
            for _ in range(rng.randint(0, 3) if n else 0):
                a = rng.randrange(n)
                p = 1 + rng.randrange((n - a) // 4 + 1)
                for i in range(a, rng.randint(a, n)):
                    own[i] = own[a + (i - a) % p]
            docs.append(own)
        first = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
        got = periodic_runs.find_runs(np.array([x * 7919 + 3 for d in docs for x in d], np.uint64), first).tolist()
        assert got == [[i, *r] for i, d in enumerate(docs) for r in runs_by_hand(d)]


def test_range_successor():
    rng = np.random.default_rng(2)
    for size in (1, 63, 64, 65, 1000):
        values = rng.integers(0, rng.integers(1, 2 * size + 1), size)
        tree = periodic_runs.WaveletTree(values)
        low = rng.integers(0, size + 1, 200)
        high = np.minimum(low + rng.integers(0, size + 1, 200), size)
        least = rng.integers(0, values.max() + 3, 200)
        want = [min((v for v in values[a:b].tolist() if v >= x), default=-1) for a, b, x in zip(low, high, least, strict=True)]
        assert tree.successor(low, high, least).tolist() == want


def collapsed_by_hand(own):
    gone = {i for s, n, q in runs_by_hand(own) for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(own) if i not in gone)


def test_runs_of_odd_rows(spark, docs, none):
    more = spark.createDataFrame([(900, "a b " * 9, "x"), (901, " ".join(["x"] * 5000), "x"), (902, "k " + "p q r " * 4 + "p z z z z z z", "x"),
                                  (None, "w " * 6, None)], "doc_id long, text string, bucket string")
    frame = docs.where("text IS NULL OR length(text) < 20000").unionByName(more, allowMissingColumns=True)
    want = Counter((r.doc_id, len(words(r.text)), tuple(runs_by_hand(words(r.text))) if r.doc_id != 901 else ((0, 5000, 1),),
                    collapsed_by_hand(words(r.text)) if r.doc_id != 901 else "x") for r in frame.collect())
    got = Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in periodic_runs.periodic_runs(frame).collect())
    assert got == want
    assert periodic_runs.periodic_runs(none).collect() == []


def test_planted_runs(docs, none):
    import zlib

    want = Counter()
    for r in docs.collect():
        own, h = words(r.text), zlib.crc32(str(r.doc_id).encode())
        if r.doc_id is None or h % 10 or not own:
            want[r.doc_id, r.text] += 1
            continue
        g = h // 10
        a = g % len(own)
        p = 1 + (len(own) - a) // (3 + g % 8)
        want[r.doc_id, " ".join(w if i < a else own[a + (i - a) % p] for i, w in enumerate(own))] += 1
    assert Counter(map(tuple, with_planted_runs(docs).collect())) == want
    assert with_planted_runs(none).collect() == []


def test_runs_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = connect(sf)
    result = con.execute(ORACLES["op13_periodic_runs"])
    df = QUERIES["op13_periodic_runs"](spark, sf)
    assert rows_of(df.columns, df.collect()) == rows_of([c[0] for c in result.description], result.fetchall())


def test_queries_agree_with_the_libraries(spark, plain):
    sf = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    pieces = packing.pack(spark.read.parquet(f"{sf}/documents.parquet")).withColumn("crc", F.crc32("ids"))
    check_packed(pieces.collect(), given, plain, packing.WINDOW)
    got = {r.doc_id: r for r in QUERIES["op11_token_alignment"](spark, sf).collect()}
    for r in given[:40]:
        n_a, n_b, groups, links = aligned_by_hand(r.text, plain)
        mine = got[r.doc_id]
        assert (mine.n_a, mine.n_b, mine.n_links) == (n_a, n_b, len(links))
        assert mine.groups_sha256 == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")
