"""The array code against plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from repopulse.llm import attention, blocks, decontamination, line_quality, mixing, near_dedup, toxicity, words
from repopulse.llm import token_files as tf

from .odd import _texts

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_words_equal_the_pattern(monkeypatch):
    texts = _texts()
    for segment in (words.SEGMENT, 64):  # also with words that cross the segments
        monkeypatch.setattr(words, "SEGMENT", segment)
        made = words.words_of(pa.array(texts), lower=True)
        plain = [SPLIT.findall((t or "").translate(FOLD)) for t in texts]
        assert np.diff(made.first).tolist() == [len(p) for p in plain]
        names = {}
        for name, value in zip((w for p in plain for w in p), made.hash.tolist(), strict=True):
            assert names.setdefault(name, value) == value
        assert len(set(names.values())) == len(names)


def test_a_word_longer_than_a_segment(monkeypatch):
    monkeypatch.setattr(words, "SEGMENT", 16)
    made = words.words_of(pa.array(["x" * 50 + " y " + "x" * 50, "x" * 49]))
    assert made.hash[0] == made.hash[2] != made.hash[3] and len(made.hash) == 4


def test_ngrams_stay_inside_texts():
    made = words.words_of(pa.array(["a b c", "a", None, "a b c d"]))
    grams, first = words.ngram_rows(made, 3)
    assert np.diff(first).tolist() == [1, 0, 0, 2] and grams[0] == grams[1] != grams[2]


def test_arrays_survive_encoding():
    given = [np.arange(5, dtype=np.uint64), np.zeros(0, np.int64), np.array([1.5])]
    back = blocks.decode(blocks.encode(given))
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(given, back, strict=True))
    keys = np.random.default_rng(1).integers(0, 1 << 62, 100, dtype=np.uint64)
    order, _ = blocks.bucket_order(keys, 7)
    assert (blocks.placed(keys, [keys[order]], 7)[0] == keys).all()


def test_base_counts_of_lines():
    def plain(text):
        text = text or ""
        own, runs, covered = SPLIT.findall(text), {}, set()
        for k in range(len(own) - 2):
            runs.setdefault(tuple(own[k : k + 3]), []).append(k)
        for places in runs.values():
            covered |= {k + i for k in places for i in range(3) if len(places) > 1}
        seen, again = set(), 0
        for line in text.split("\n"):
            if SPLIT.search(line):
                again += line in seen
                seen.add(line)
        return len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)

    rng = random.Random(3)
    texts = ["".join(rng.choice(["a", "bé", "c ", " ", "\n", "x y", "#", "\t", "q\r\n", "日本"]) for _ in range(rng.randrange(60))) for _ in range(500)]
    texts += [*_texts(), "\n", "\n\n", "a\na\na"]
    counts, bounds, columns, _ = line_quality.describe(*words.text_buffer(pa.array(texts)))
    got = zip(*[counts[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], strict=True)
    assert list(got) == [plain(t) for t in texts]
    assert np.diff(bounds).tolist() == [len((t or "").split("\n")) for t in texts] and columns.max() < line_quality.FEATURES


def test_viterbi_finds_the_best_marks():
    rng = np.random.default_rng(2)
    field = line_quality.LineField()
    field.weights, field.moves, field.first = rng.normal(size=field.weights.shape), rng.normal(size=(2, 2)), rng.normal(size=2)
    bounds = np.array([0, 5, 6, 13])
    columns = rng.integers(0, line_quality.FEATURES, (13, 4))
    marks, score = field.decode(columns, bounds), field.emissions(columns)
    for a, b in zip(bounds, bounds[1:], strict=False):
        def value(path, a=a):
            return field.first[path[0]] + sum(score[a + i, m] for i, m in enumerate(path)) + sum(field.moves[x, y] for x, y in zip(path, path[1:], strict=False))
        best = max(np.ndindex(*[2] * (b - a)), key=value)
        assert tuple(marks[a:b]) == best


def test_the_field_learns():
    rng = np.random.default_rng(3)
    y = np.repeat(rng.integers(0, 2, 60), 4)
    columns = np.stack([y * 3 + rng.integers(0, 3, len(y)), rng.integers(10, 20, len(y))], axis=1)
    field = line_quality.LineField().fit(columns, np.arange(0, len(y) + 1, 4), y)
    assert (field.decode(columns, np.arange(0, len(y) + 1, 4)) == y).mean() > 0.98


def test_posterior_bound():
    from math import comb

    for m in (25, 125):
        c = near_dedup.least_matches(m, 1e-6)
        tail = lambda c: sum(comb(m + 1, k) * 0.85**k * 0.15 ** (m + 1 - k) for k in range(c + 1))  # noqa: B023, E731
        assert tail(c) >= 1e-6 > tail(c - 1)


def test_shingle_sets():
    texts = _texts()
    grams, first = near_dedup.shingles(words.words_of(pa.array(texts), lower=True))
    for text, n in zip(texts, np.diff(first).tolist(), strict=True):
        own = SPLIT.findall((text or "").translate(FOLD))
        assert n == (len({tuple(own[k : k + 5]) for k in range(len(own) - 4)}) if len(own) > 4 else bool(own))


def test_edit_match_equals_all_parts():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
        return row[-1]

    rng = np.random.default_rng(1)
    for _ in range(60):
        a, b = (rng.integers(0, 4, rng.integers(1, 7)).astype(np.uint64) for _ in range(2))
        d, at, n = decontamination.edit_match(a, b)
        assert d == min(distance(a.tolist(), b[i:j].tolist()) for i in range(len(b) + 1) for j in range(i, len(b) + 1))
        assert d == distance(a.tolist(), b[at : at + n].tolist())


def test_screen_and_walk_find_edited_items():
    rng = random.Random(2)
    items = [[f"i{k}_{j}" for j in range(rng.randrange(8, 50))] for k in range(30)] + [["tiny"], ["two", "words"]]
    block = decontamination.ItemBlock(list(range(len(items))), [words.words_of(pa.array([" ".join(i)])).hash for i in items])
    texts, wanted = [], set()
    for j in range(150):
        number = rng.randrange(len(items))
        own = list(items[number])
        for _ in range(decontamination.edits(len(own))):
            place = rng.randrange(len(own))
            kind = rng.random()
            if kind < 0.4:
                own[place] = f"z{rng.random()}"
            elif kind < 0.7:
                own.insert(place, f"y{rng.random()}")
            elif len(own) > 1:
                del own[place]
        around = [f"a{rng.randrange(500)}" for _ in range(60)]
        texts.append(" ".join(around[:30] + own + around[30:]))
        wanted.add((j, number))
    made = words.words_of(pa.array([*texts, " ".join(f"a{k}" for k in range(400)), None]))
    found = {(m[0], m[1]) for m in block.matches(made.hash, made.first)}
    assert found <= wanted and len(found) >= 0.97 * len(wanted)


def test_every_token_is_scored_once_and_probabilities_sum_to_one():
    lengths = [0, 1, 23, 24, 31, 32, 33, 57, 200]
    ids = np.arange(sum(lengths), dtype=np.int32) % 30
    first = np.concatenate([[0], np.cumsum(lengths)])
    x, y, valid, begin, text = attention.windows(ids, first, 30)
    for t, n in enumerate(lengths):
        own = [v for i in np.flatnonzero(text == t) for v in y[i, begin[i] : valid[i]].tolist()]
        assert own == [*ids[first[t] : first[t + 1]].tolist(), 30] and len(own) == n + 1
        assert x[np.flatnonzero(text == t)[0], 0] == 30
    tokens = [b" a%d" % i if i % 2 else b"a%d" % i for i in range(31)]
    model = attention.AttentionLM(np.arange(31) * 5, tokens, 30)
    window = np.tile(x[:1], (31, 1))
    target = np.tile(y[:1], (31, 1))
    target[:, 0] = np.arange(31)
    chances = np.exp(model.log_probs(window, target, np.ones(31, int), np.zeros(31, int)))
    assert chances.sum() == pytest.approx(1, abs=1e-4)


def test_attention_gradient(monkeypatch):
    tokens = [b" %d" % i if i % 3 else b"%d" % i for i in range(41)]
    model = attention.AttentionLM(np.arange(41) + 1, tokens, 40)
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 41, (2, 3, attention.CONTEXT)).astype(np.int32)
    valid = np.array([attention.CONTEXT, 5, 1])
    grads, _ = model._step(x, y, valid)
    for name, place in (("qkv", (3, 4)), ("qkv", (1, 20)), ("near", (1, 2)), ("back", (2, 2)), ("up", (1, 1)), ("down", (3, 3)), ("out", (4, 1)), ("inner", (0, 5, 2))):
        own, step, losses = model.dense[name], np.float32(1e-2), []
        for sign in (1, -2):
            own[place] += sign * step
            model._step(x, y, valid)
            losses.append(model.loss)
        own[place] += step
        assert (losses[0] - losses[1]) / (2 * step) == pytest.approx(grads[name][place], abs=2e-3, rel=0.1)


def test_the_model_learns():
    tokens = [b" %d" % i for i in range(21)]
    model = attention.AttentionLM(np.ones(21), tokens, 20)
    ids = np.tile(np.arange(20, dtype=np.int32), 100)
    x, y, valid, begin, _ = attention.windows(ids, np.array([0, len(ids)]), 20)
    model.fit(x, y, valid, epochs=30)
    assert model.log_probs(x, y, valid, begin).mean() > -0.3


def test_convolution_scores(monkeypatch):
    rng = random.Random(1)
    plain = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choice(plain) for _ in range(30)) for _ in range(600)]
    labels = np.array([rng.random() < 0.3 for _ in texts], float)
    texts = [t + " nastyness" + rng.choice("abcdefgh") if y else t for t, y in zip(texts, labels, strict=True)]
    buckets, first, language = toxicity.tokens(pa.array(texts))
    parts = [buckets[a:b] for a, b in zip(first, first[1:], strict=False)]
    net = toxicity.ConvNet().fit(parts[:300], labels[:300])
    rest = np.concatenate(parts[300:]), first[300:] - first[300]
    net.calibrate(net.logits(*rest), labels[300:], language[300:])
    new, bounds, spoken = toxicity.tokens(pa.array(["w1 NASTYNESSX w2", "w1 w2 w3", "", None, "nastynessa"]))
    assert (net.scores(new, bounds, spoken) >= 0.5).tolist() == [True, False, False, False, True]
    alone = toxicity.tokens(pa.array(["w1 NASTYNESSX w2"]))
    assert net.scores(*alone)[0] == pytest.approx(net.scores(new, bounds, spoken)[0], rel=1e-4)


def test_language_from_function_words():
    _, _, language = toxicity.tokens(pa.array(["the cat and the dog", "der Hund und die Katze", "le chien et les chats", "el perro y los gatos", "xyz", None]))
    assert [toxicity.LANGUAGES[i] for i in language] == ["en", "de", "fr", "es", "other", "other"]


def test_pivots_keep_the_words():
    rng = random.Random(5)
    sizes = [rng.choice([0, 1, 5, 80, 400, 9000]) for _ in range(300)]
    start = [rng.choice([0.0, 1.0, 0.3, 0.75]) for _ in sizes]
    chances, left = mixing.pivot(start, sizes, [rng.getrandbits(64) for _ in sizes])
    assert all(p in (0.0, 1.0) for i, p in enumerate(chances) if i != left)
    assert sum(p * s for p, s in zip(chances, sizes, strict=True)) == pytest.approx(sum(p * s for p, s in zip(start, sizes, strict=True)))


def test_pivots_keep_expectations():
    taken = Counter()
    for seed in range(3000):
        chances, left = mixing.pivot([0.25] * 4, [3, 1, 7, 2], [mixing_key(seed, i) for i in range(4)])
        for i, p in enumerate(chances):
            taken[i] += p
    assert all(abs(taken[i] / 3000 - 0.25) < 0.04 for i in range(4))


def mixing_key(seed, i):
    return random.Random(seed * 7 + i).getrandbits(64)


def test_perfect_hash_is_minimal():
    for n in (0, 1, 2, 100, 20_000):
        keys = np.random.default_rng(n).choice(1 << 40, n, replace=False).astype(np.int64) - (1 << 39)
        made = tf.PerfectHash.build(keys)
        assert sorted(made.slots(keys).tolist()) == list(range(n))


def test_index_finds_its_keys_and_no_others():
    ids = np.array([-5, -5, 0, 3, 3, 3, 9], np.int64)
    index = tf.ShardIndex.parse(tf.ShardIndex.build(ids, np.arange(1, 8)).dump())
    first, records = index.find(np.array([-5, 0, 3, 9]))
    assert first.tolist() == [0, 2, 3, 6] and records.tolist() == [2, 1, 3, 1]
    assert index.find(np.arange(10_000, 40_000))[1].sum() == 0


def test_word_by_word_ids_equal_the_tokenizers():
    from tokenizers import Tokenizer

    path = tf.default_vocabulary()
    whole, encoder, rng = Tokenizer.from_file(path), tf.WordEncoder.load(path), random.Random(1)
    parts = ["a", "B", "é", "É", "ß", "İ", "Σ", "ς", "́", " ", " ", "'s", "'LL", "1", "٣", "x", "<|endoftext|>", "<|", "|>", "\x00", "\x1c", "\x7f",
             "~", "日", "😀", "\xa0", " ", "\n", "\t", "ǆ", "ﬁ", "!", "..."]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(1500)] + _texts()
    ids, sizes = tf.encode_texts(pa.array(texts), encoder)
    ends = np.cumsum(sizes)
    for text, low, high in zip(texts, (ends - sizes).tolist(), ends.tolist(), strict=True):
        assert ids[low:high].tolist() == [*whole.encode(text or "", add_special_tokens=False).ids, tf.END]


def test_settled_rows_come_near_their_words():
    rng = random.Random(9)
    for _ in range(300):
        sizes = [rng.choice([1, 2, 3, 5, 9, 20, 50, 400, 2500, 20_000]) for _ in range(rng.randrange(1, 30))] + [1, 2, 3, 5, 9, 17, 33, 65, 129, 257, 513, 1025, 2049, 4097, 8193] * 2
        chances = [rng.random() for _ in sizes]
        made = mixing.settle(chances, sizes, range(len(sizes)))
        assert set(made) <= {0.0, 1.0}
        assert abs(sum(a * b for a, b in zip(made, sizes)) - sum(a * b for a, b in zip(chances, sizes))) <= 2
    assert mixing.settle([0.4], [7], [0]) == [0.0] and mixing.settle([0.6], [7], [0]) == [1.0]
    assert mixing.settle([0.3, 0.5], [7, 7], [1]) == [0.3, 0.0] and mixing.settle([], [], []) == []


def test_groups_keep_their_words_and_hold_some_back():
    rng = random.Random(10)
    sizes = [rng.choice([0, *(1 << k for k in range(13))]) for _ in range(400)]
    chances, keys = [rng.random() for _ in sizes], [rng.getrandbits(64) for _ in sizes]
    made = mixing.round_group(chances, sizes, keys, last=False)
    is_open = [j for j, x in enumerate(made) if 0 < x < 1]
    assert len(is_open) <= 2 * 13 + 1 and set(mixing.held_back(chances, sizes, keys)) <= set(is_open)
    words = lambda c: sum(a * b for a, b in zip(c, sizes))
    assert words(made) == pytest.approx(words(chances))
    closed = mixing.round_group(chances, sizes, keys, last=True)
    assert set(closed) <= {0.0, 1.0} and abs(words(closed) - words(chances)) <= 1


def test_small_sources_meet_their_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    made = mixing.mix(docs).groupBy("target", "source_size").agg(F.sum("taken").alias("taken")).collect()
    assert len(made) > 10 and max(abs(r.taken / r.target - 1) for r in made) < 0.002


def test_shards_of_repeated_ids():
    rng = random.Random(3)
    for _ in range(100):
        rows = [(rng.choice([tf.NO_ID, -5, 0, 1, 2, 7, 7, 7]), i) for i in range(rng.randrange(0, 40))]
        starts = sorted(rng.sample(rows, rng.randrange(0, len(rows) + 1)))
        ids, numbers = (np.array([r[k] for r in rows], np.int64) for k in (0, 1))
        got = tf.shard_of(tuple(np.array([s[k] for s in starts], np.int64) for k in (0, 1)), ids, numbers)
        assert got.tolist() == [sum(s <= r for s in starts) for r in rows]


def test_words_are_encoded_as_the_library_does():
    from tokenizers import Tokenizer

    path, rng = tf.default_vocabulary(), random.Random(5)
    whole, encoder = Tokenizer.from_file(path), tf.WordEncoder.load(path)
    parts = [*"aAbBiIzZ09's'tll.,!<|>-_\x1c\x00\x7f", *"ÉßİıſŸŉĀµª²漢é", "\u0301", "×", "÷", "😀", "<|endoftext|>", "\xa0", " ", " ", "\n", "\t", "ing", "'re", "'ve"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + ["", None, "a" * 3000]
    ids, sizes = tf.encode_texts(pa.array(texts, pa.string()), encoder)
    ends = np.cumsum(sizes)
    assert encoder.fast
    for text, a, b in zip(texts, ends - sizes, ends, strict=True):
        assert ids[a:b].tolist() == [*whole.encode(text or "", add_special_tokens=False).ids, tf.END], text
    ids, sizes = tf.encode_texts(pa.array([None, " "], pa.string()), encoder)
    assert ids.tolist() == [tf.END] * 2 and sizes.tolist() == [1, 1]


def test_every_text_has_a_window_to_learn():
    from repopulse.llm import lm_scoring

    rng = np.random.default_rng(4)
    count = rng.integers(1, 100, 200)
    text = np.repeat(np.arange(200), count)
    kept = np.bincount(text[lm_scoring.one_in(text, 16)], minlength=200)
    assert (kept >= 1).all() and (kept >= count // 16).all() and (kept <= -(-count // 16)).all()
    assert lm_scoring.one_in(np.zeros(0, np.int64), 16).tolist() == []


def test_every_window_of_every_text_is_learned():
    from repopulse.llm import lm_scoring

    text = np.repeat(np.arange(200), np.random.default_rng(4).integers(1, 100, 200))
    assert lm_scoring.one_in(text, lm_scoring.ONE_IN).all()


def test_forward_pass_against_a_plain_one():
    """Every target's probability, token by token, from the weights alone."""
    rng = np.random.default_rng(6)
    tokens = [b" a", b"b", b" c", b"dd", b" e", b"f", b" gg", b"h", b" i", b"<end>"]
    counts = np.array([50, 40, 30, 20, 10, 9, 8, 7, 6, 5])
    model = attention.AttentionLM(counts, tokens, 9, seed=3)
    for name, value in model.dense.items():
        model.dense[name] = (value + rng.normal(0, 0.05, value.shape)).astype(np.float32)
    ids = rng.integers(0, 9, 60).astype(np.int32)
    x, y, valid, begin, _ = attention.windows(ids, np.array([0, 60]), 9)
    got = model.log_probs(x, y, valid, begin)
    p, at = {n: v.astype(float) for n, v in model.dense.items()}, 0
    for w in range(len(x)):
        e = model.embed[x[w]].astype(float)
        q, k, v = (e @ p["qkv"]).reshape(-1, 3, attention.HEADS, attention.HEAD).transpose(1, 2, 0, 3)
        for i in range(begin[w], valid[w]):
            seen = []
            for h in range(attention.HEADS):
                scores = np.array([q[h, i] @ k[h, j] / attention.HEAD**0.5 + p["near"][h, i - j] for j in range(i + 1)])
                weight = np.exp(scores) / np.exp(scores).sum()
                seen.append(weight @ v[h, : i + 1])
            first = np.append(e[i] + np.concatenate(seen) @ p["back"], 1)
            last = np.append(first[:-1] + np.maximum(first @ p["up"], 0) @ p["down"], 1)
            by_class = last @ p["out"]
            kinds = by_class - np.log(np.exp(by_class).sum())
            chances = np.zeros(10)
            for t in range(10):
                inner = last @ p["inner"][model.kind[t]] if model.kind[t] < model.full else None
                chances[t] = kinds[model.kind[t]] + (model.within[t] if inner is None else inner[model.member[t]] - np.log(np.exp(inner).sum()))
            assert np.exp(chances).sum() <= 1 + 1e-6
            assert got[at] == pytest.approx(chances[y[w, i]], abs=2e-3)
            at += 1
    assert at == len(got) == 61
