"""Every operator on odd rows, on no rows, and against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from repopulse.llm import decontamination, line_quality, lm_scoring, mixing, near_dedup, preferences, substring_dedup, toxicity, url_filter
from repopulse.llm import token_files as tf

from . import odd

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LABELS = "doc_id long, quality int, toxic int, text string"


def words(text, fold=False):
    text = text or ""
    return SPLIT.findall(text.translate(FOLD) if fold else text)


@pytest.fixture(scope="module")
def docs(spark):
    return odd.frame(spark)


@pytest.fixture(scope="module")
def none(spark):
    return odd.frame(spark, [])


@pytest.fixture(scope="module")
def labels(spark):
    data = [(i * 3 - 7, int(i % 3 > 0), int(i % 4 == 0), "t") for i in range(20)] + [(2, 1, 1, "t"), (None, 1, 1, "t"), (5, None, None, "t")]
    return spark.createDataFrame(data, LABELS)


def order(x):
    return tuple((v is not None, v) for v in x)


def same(got, want):
    assert sorted(map(tuple, got), key=order) == sorted(map(tuple, want), key=order)


def test_cut_repeats(docs, none, monkeypatch):
    rows = sorted(odd.rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    first = {}
    for r in rows:
        own = words(r[1])
        for k in range(len(own) - 12):
            first.setdefault(tuple(own[k : k + 13]), r[0])
    want = []
    for r in rows:
        own = words(r[1])
        gone = {k + i for k in range(len(own) - 12) for i in range(13) if first[tuple(own[k : k + 13])] != r[0]}
        kept = [w for i, w in enumerate(own) if i not in gone]
        want.append((r[0], len(own), len(gone), " ".join(kept)))
    made = substring_dedup.cut_repeats(docs)
    same(made.select("doc_id", "n_words", "n_removed", "kept_text").collect(), want)
    assert made.where("n_removed <> aggregate(repeats, 0L, (a, r) -> a + r.n)").isEmpty()
    assert substring_dedup.cut_repeats(none).isEmpty()


def groups(rows):
    """Component ids and set sizes by brute force."""
    sets = [frozenset([tuple(w[k : k + 5]) for k in range(len(w) - 4)] or ([tuple(w)] if w else [])) for w in (words(r[1], True) for r in rows)]
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                label[top(i)] = top(j)
    ids = defaultdict(list)
    for i, r in enumerate(rows):
        ids[top(i)].append(r[0])
    lowest = {k: None if None in v else min(v) for k, v in ids.items()}
    return [(r[0], len(s), lowest[top(i)], r[0] == lowest[top(i)]) for i, (r, s) in enumerate(zip(rows, sets, strict=True))]


def test_near_duplicates(docs, none):
    made = near_dedup.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()
    same(made, groups(odd.rows()))
    assert near_dedup.near_duplicates(none).isEmpty()


def test_chains_that_no_bucket_centre_joins(spark, monkeypatch):
    """Neighbours are linked, the ends are far apart; buckets are cut into blocks of a few nodes."""
    monkeypatch.setattr(near_dedup, "MEMBERS", 4)
    base, rows = [f"w{i}" for i in range(300)], []
    order_ = list(range(40))
    random.Random(1).shuffle(order_)
    for step, i in enumerate(order_):
        text = [f"new{j}" if j < 5 * i else w for j, w in enumerate(base)]
        rows.append((100 + step, " ".join(text), *[None] * 2, 1, *["x"] * 0, True, *["x"] * 8))
    docs = odd.frame(spark, rows)
    made = near_dedup.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()
    same(made, groups(rows))
    assert len({r.component_id for r in made}) < 40


def test_drop_near_duplicates(docs):
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    want = {(r[0], r[1]) for r, g in zip(odd.rows(), groups(odd.rows()), strict=True) if g[3]}
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert set(got) <= want and len(got) == len(set(got))
    assert {g[2] for g in groups(odd.rows())} == {d for d, _ in got} | {g[2] for g in groups(odd.rows()) if g[1] == 0}


def test_line_quality(spark, docs, none, labels):
    field = line_quality.fit_field(docs, labels)
    made = line_quality.judge(docs, field)
    for r in made.collect():
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    assert made.count() == len(odd.rows()) and line_quality.judge(none, field).isEmpty()
    untaught = line_quality.fit_field(none, labels)
    kept = line_quality.drop_boilerplate(docs, untaught)
    assert kept.schema == docs.schema and kept.count() == line_quality.judge(docs, untaught).where("kept").count()
    prose = "\n".join(" ".join(f"p{i}{j}" for j in range(12)) + "." for i in range(8))
    junk = "\n".join(" ".join(f"p{i}{j}***" for j in range(12)) for i in range(8))
    some = odd.frame(spark, [(i, prose if i % 2 else junk, *odd.rows()[0][2:]) for i in range(40)])
    good = spark.createDataFrame([(i, i % 2, 0, "") for i in range(40)], LABELS)
    assert {r.doc_id % 2 for r in line_quality.judge(some, line_quality.fit_field(some, good)).where("kept").collect()} == {1}


def test_toxicity(spark, docs, none, labels):
    made = toxicity.score_documents(docs, labels).collect()
    assert len(made) == len(odd.rows()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in made)
    assert all(r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0) for r in made)
    again = toxicity.score_documents(docs, labels.where("toxic IS NULL")).collect()
    assert {r.score for r in again} == {0.0}
    assert toxicity.score_documents(none, labels).isEmpty()


def test_lm_scores(docs, none):
    rows = odd.rows()
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 == 2 for r in rows]
    counts = Counter(w for r, h in zip(rows, held, strict=True) if not h for w in [*words(r[1], True), "\n"])
    n, v = sum(counts.values()), len(counts)
    made = lm_scoring.score_texts(docs, fit_windows=200)
    got = sorted((order((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.held_out)), round(r.base_score, 6)) for r in made.collect())
    want = []
    for r, h in zip(rows, held, strict=True):
        own = [*words(r[1], True), "\n"]
        base = sum(log10((counts[w] + 1) / (n + v + 1)) for w in own)
        want.append((order((r[0], len(own), sum(counts[w] > 0 for w in own), n, h)), round(base, 6)))
    assert [g[0] for g in got] == [w[0] for w in sorted(want)]
    assert np.allclose([g[1] for g in got], [w[1] for w in sorted(want)])
    assert made.where("score >= 0 OR isnan(score)").isEmpty()
    assert lm_scoring.score_texts(none).isEmpty()


def test_mixing(docs, none, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 3)
    monkeypatch.setattr(mixing, "FAN_IN", 2)
    rows = odd.rows()
    made = mixing.mix(docs).collect()
    same([(r.doc_id, r.size) for r in made], [(r[0], len(words(r[1]))) for r in rows])
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in capped)
        level = left / sum(weight[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and level * weight[s] >= 2 * sizes[s]}
        if not over:
            break
        capped |= over
    target = {s: min(level * weight[s], 2 * sizes[s]) for s in names}
    by_size = {sizes[s]: target[s] for s in names}
    taken = Counter()
    for r in made:
        assert r.target == pytest.approx(by_size[r.source_size]) and 0 <= r.taken <= 2 * r.size
        taken[r.source_size] += r.taken
    largest = max(len(words(r[1])) for r in rows)
    assert all(abs(taken[k] - by_size[k]) <= largest / 2 + 1 for k in by_size)
    same(mixing.mix(docs.repartition(3)).collect(), made)
    copies = mixing.mixed_documents(docs)
    assert copies.schema == docs.schema and copies.count() == sum(r.copies for r in made)
    assert mixing.mix(none).isEmpty() and mixing.mixed_documents(none).isEmpty()


def test_leaks(spark, docs, none):
    passage = " ".join(f"p{i}" for i in range(60))
    items = spark.createDataFrame([(7, passage, 1), (7, passage, 1), (8, None, 1), (9, "", 1), (10, passage.replace("p9", "changed"), 1), (11, "not there at all ever", 1)],
                                  "item_id long, text string, doc_id long")
    found = decontamination.leaks(docs, items, block_words=70)
    want = {r[0] for r in odd.rows() if passage in (r[1] or "")}
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(d, i) for d in want for i in (7, 10)}
    assert {r.distance for r in found.where("item_id = 7").collect()} == {0} and {r.n_words for r in found.collect()} == {60}
    clean = decontamination.drop_leaks(docs, items)
    assert clean.schema == docs.schema and not {r.doc_id for r in clean.collect()} & want
    assert clean.count() == sum(passage not in (r[1] or "") for r in odd.rows())
    assert decontamination.leaks(none, items).isEmpty() and decontamination.leaks(docs, items.limit(0)).isEmpty()
    assert decontamination.drop_leaks(docs, items.limit(0)).count() == docs.count()


def test_copies_back_to_back_are_parts_each(spark):
    item = [f"p{i}" for i in range(40)]
    changed = ["other" if i in (3, 20) else w for i, w in enumerate(item)]
    texts = [item * 3, [*item, "between", *changed, *item], ["x"] * 30 + item + ["y"] * 30, item[:38] * 2]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    found = decontamination.leaks(docs, spark.createDataFrame([(7, " ".join(item))], "item_id long, text string"))
    got = sorted((r.doc_id, r.first_word, r.distance) for r in found.collect())
    assert [g for g in got if g[0] < 3] == [(0, 0, 0), (0, 40, 0), (0, 80, 0), (1, 0, 0), (1, 41, 2), (1, 81, 0), (2, 30, 0)]
    assert [g[2] <= 2 for g in got if g[0] == 3] == [True, True]


def test_token_files(spark, docs, none):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tf.default_vocabulary())
    manifest = tf.write_shards(docs, shards=5)
    made = sorted(tf.read_shards(manifest).collect(), key=lambda r: r.start)
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in made]
    assert keys == sorted(keys) and len(made) == len(odd.rows())
    at = 0
    for r in made:
        assert r.start == at
        at += r.n_tokens
    sums = []
    for r in odd.rows():
        ids = [*whole.encode(r[1] or "", add_special_tokens=False).ids, 1]
        sums.append((r[0], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    same([(r.doc_id, r.n_tokens, r.ids_crc32) for r in made], sums)
    wanted = spark.createDataFrame([(odd.rows()[0][0],), (odd.rows()[8][0],), (99_999,), (None,)], "doc_id long")
    own = [(r[0], [*whole.encode(r[1] or "", add_special_tokens=False).ids, 1]) for r in odd.rows() if r[0] in (odd.rows()[0][0], odd.rows()[8][0])]
    assert sorted((r.doc_id, r.ids) for r in tf.fetch(manifest, wanted).collect()) == sorted(own)
    assert tf.read_shards(tf.write_shards(none)).isEmpty()


def test_urls(spark):
    urls = ["http://A.Example.NET/en/x?q#f", "https://b.net", "x://b.net/a", "http://example.com/de/1", "http://net.example.com/en/", "http://w.org/fr/", "no url", None, "",
            "http://freecasinobets.example.com/x", "http://my.host#x/y", "http://thehealthblog.com/article", "a://b://c/d", "http://host:80/p\n?x", "http://example.net/e"]
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls)] + [(0, urls[0], "h", "v"), (None, None, None, None)],
                                  "page_id long, url string, host string, verdict string")
    made = url_filter.judge_urls(pages).collect()
    for r in made:
        url = urls[r.page_id] if r.page_id is not None else None
        place = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        assert (r.host, r.path) == ((place[1].translate(FOLD), place[2]) if place else ("", ""))
    by_id = {r.page_id: (r.rule, r.verdict) for r in made}
    assert [by_id[i] for i in range(7)] == [("example.net/en/", "allow"), (None, "allow"), ("net/", "block"), ("example.com/de/", "block"),
                                           (None, "allow"), ("org/fr/", "allow"), (None, "allow")]
    assert by_id[9] == (None, "block") and by_id[11] == (None, "allow") and by_id[14] == ("net/", "block") and len(made) == len(urls) + 2
    assert url_filter.judge_urls(pages.limit(0)).isEmpty()


def test_segmentation_is_the_best_split():
    model = url_filter.HostWords({"the": 50, "there": 9, "rein": 5, "in": 40, "re": 20}, {"casino": 50}, ["blog"])

    def cost(parts):
        return sum(model.cost.get(p, model.unknown + model.letter * len(p)) for p in parts)

    def splits(s):
        yield from ([s[:i], *rest] for i in range(1, len(s)) for rest in splits(s[i:]))
        yield [s]

    for label in ("therein", "thecasinoblog", "xxthere", "inxre", "zzz", "therethe"):
        assert cost(model.split(label)) == pytest.approx(min(map(cost, splits(label))))
    assert model.split("") == [] and "".join(model.split("x" * 5000)) == "x" * 5000


def test_preferences(spark):
    turns = [(0, 0, "user", "hi", 1), (0, 1, "assistant", "yes", 1), (0, 2, "user", "more", 1), (0, 3, "assistant", "good", 1),
             (1, 0, "user", "hi", 1), (1, 1, "assistant", "yes", 1), (1, 2, "user", "less", 1), (1, 3, "assistant", "bad", 1),
             (2, 0, "user", "alone", 1), (2, 1, "assistant", None, 1), (4, 0, None, None, 1), (5, 0, "", "", 1), (5, 0, "", "", 1),
             (7, 0, "user", "right only", 1), (None, 0, "user", "x", 1), (8, None, "user", "x", 1)]
    given = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string, pair_id int")
    parts = preferences.segments(preferences.sides_of(given, preferences.neighbours(given)))
    got = sorted((r.pair_id, r.segment, r.turn, r.role, r.loss) for r in parts.collect())
    assert got == sorted([
        (0, "prompt", 0, "user", False), (0, "prompt", 1, "assistant", False), (0, "chosen", 2, "user", False), (0, "chosen", 3, "assistant", True),
        (0, "rejected", 2, "user", False), (0, "rejected", 3, "assistant", True), (1, "chosen", 0, "user", False), (1, "chosen", 1, "assistant", True),
        (2, "prompt", 0, "", False), (3, "rejected", 0, "user", False)])
    row = preferences.rows_of_pairs(parts).where("pair_id = 0").first()
    assert row.prompt == "<|user|>\nhi\n<|assistant|>\nyes\n"
    assert [row.chosen[s.start : s.end] for s in row.chosen_mask] == ["good\n"]
    assert [row.rejected[s.start : s.end] for s in row.rejected_mask] == ["bad\n"]
    empty = given.limit(0)
    assert preferences.segments(preferences.sides_of(empty, preferences.neighbours(empty))).isEmpty()
    assert preferences.rows_of_pairs(preferences.segments(preferences.swapped_replies(empty))).isEmpty()


def test_swapped_replies(spark):
    rng = random.Random(6)
    said = {}
    for c in range(-2, 12):
        for t in sorted(rng.sample(range(200), rng.randrange(0, 9))):
            said[c, t] = (rng.choice(["user", "assistant", "system"]), rng.choice(["a", "b c", "é\n", ""]))
    said |= {(20, t): ("assistant" if t % 2 else "user", f"t{t}") for t in range(300)} | {(21, 0): ("assistant", "short")}
    rows = [(c, t, r or None, x or None) for (c, t), (r, x) in said.items()] + [(None, 0, "user", "x"), (3, None, "assistant", "x")]
    given = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(5)
    turns = {c: sorted((t, *said[c, t]) for c2, t in said if c2 == c) for c, _ in said}
    last = {c: max((t for t in own if t[1] == "assistant"), default=None) for c, own in turns.items()}
    want = {}
    for c, own in turns.items():
        other = last.get(c ^ 1)
        rejected = [(t, r, other[2] if (t, r, x) == last[c] else x) for t, r, x in own] if last[c] and other else []
        common = next((i for i, (x, y) in enumerate(zip(own, rejected, strict=False)) if x != y), min(len(own), len(rejected)))
        for name, side in (("prompt", own[:common]), ("chosen", own[common:]), ("rejected", rejected[common:])):
            for t, r, x in side:
                row = want.setdefault((c, t // 64), {"prompt": "", "chosen": "", "rejected": "", "loss": {"chosen": [], "rejected": []}})
                row[name] += f"<|{r}|>\n{x}\n"
                if name != "prompt" and r == "assistant":
                    row["loss"][name].append(x + "\n")
    got = preferences.rows_of_pairs(preferences.segments(preferences.swapped_replies(given))).collect()
    assert len(got) == len(want) and any(r.prompt and r.chosen and r.rejected for r in got)
    for r in got:
        w = want[r.pair_id, r.stretch]
        assert (r.prompt, r.chosen, r.rejected) == (w["prompt"], w["chosen"], w["rejected"])
        assert [r.chosen[m.start : m.end] for m in r.chosen_mask] == w["loss"]["chosen"]
        assert [r.rejected[m.start : m.end] for m in r.rejected_mask] == w["loss"]["rejected"]


def test_native_formatting_has_no_python(spark, capsys):
    given = spark.createDataFrame([(0, 0, "user", "hi")], "conv_id long, turn int, role string, text string")
    preferences.rows_of_pairs(preferences.segments(preferences.swapped_replies(given))).explain()
    plan = capsys.readouterr().out
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


def test_sha_of_kept_words(spark):
    assert spark.range(1).select(F.sha2(F.lit("a é"), 256)).first()[0] == hashlib.sha256("a é".encode()).hexdigest()


def test_lm_learns_from_every_training_document(spark):
    """No window is drawn for the start, so only the pass over all documents can teach; each part has words of its own."""
    texts = [" ".join(f"{a} {b}" for _ in range(200)) for a, b in (("red", "house"), ("green", "river"), ("blue", "window"), ("black", "garden"))]
    docs = spark.createDataFrame([(i, texts[i % 4]) for i in range(40)], "doc_id long, text string").repartitionByRange(4, "doc_id")
    source = lm_scoring.default_subwords()
    subwords = lm_scoring.Subwords.load(*source)
    packed = lm_scoring.cut_lineage(lm_scoring.B.pack(lm_scoring.ship(spark) and docs), "lm-test")
    histogram = np.bincount(subwords.of(" ".join(texts).encode().split())[0], minlength=len(subwords.tokens)) * 8
    model = lm_scoring.train_model(packed, histogram, source, 7, 2, fit_windows=0)
    start = lm_scoring.attention.AttentionLM(histogram, subwords.tokens, subwords.end)
    for text in texts:
        ids = subwords.of(text.encode().split())[0]
        x, y, valid, begin, _ = lm_scoring.attention.windows(ids, np.array([0, len(ids)]), subwords.end)
        assert model.log_probs(x, y, valid, begin).mean() > start.log_probs(x, y, valid, begin).mean() + 0.01


def _edited(rng, item, kind, k):
    other = list(item)
    for _ in range(k):
        at = int(rng.integers(0, len(other)))
        what = ("replace", "insert", "delete")[rng.integers(0, 3)] if kind == "mixed" else kind
        if what == "delete":
            del other[at]
        else:
            other[at : at + (what == "replace")] = [int(rng.integers(1, 1 << 62))]
    return other


def _share_found(lengths, kind, before, behind, trials):
    rng = np.random.default_rng(3)
    items = [rng.integers(1, 1 << 62, n, dtype=np.uint64) for n in lengths]
    block, found = decontamination.ItemBlock(list(range(len(items))), items), 0
    for i, item in enumerate(items):
        for _ in range(trials):
            middle = _edited(rng, item.tolist(), kind, decontamination.edits(len(item)))
            text = [*rng.integers(1, 1 << 62, before).tolist(), *middle, *rng.integers(1, 1 << 62, behind).tolist()]
            found += i in {m[1] for m in block.matches(np.array(text, np.uint64), np.array([0, len(text)]))}
    return found / (len(items) * trials)


def test_leaks_that_are_a_whole_text():
    """Items with as many words deleted as the distance allows have no window of their own length."""
    assert _share_found([15, 20, 45, 59], "delete", 0, 0, 10) >= 0.7


@pytest.mark.parametrize("kind", ["replace", "insert", "delete", "mixed"])
@pytest.mark.parametrize("behind", [0, 30])
def test_leaks_of_every_length_and_kind_of_edit(kind, behind):
    assert _share_found([20, 45, 59, 120, 300], kind, 30, behind, 6) >= 0.93


@pytest.mark.parametrize("listed", [5_000, 50_000])
def test_a_short_word_does_not_cut_an_unknown_name(listed):
    model = url_filter.HostWords({"the": listed}, {"bet": 50, "sex": 50, "pill": 50}, ["es", "ary", "com"])

    def cost(parts):
        return sum(model.cost.get(p, model.unknown + model.letter * len(p)) for p in parts)

    def splits(s):
        yield from ([s[:i], *rest] for i in range(1, len(s)) for rest in splits(s[i:]))
        yield [s]

    assert model.split("zorbetla") == ["zorbetla"]
    for label in ("zorbetla", "essexvale", "caterpillary", "thebetzz", "zzthebet", "betbet"):
        assert cost(model.split(label)) == pytest.approx(min(map(cost, splits(label))))


def test_url_counts_have_no_cap(spark):
    """More words on two sites than any fixed dictionary of 50,000; each of them, also the last, splits a name."""
    word = "concat('q', translate(cast(id + 100000 as string), '0123456789', 'abcdefghij'))"
    many = spark.range(52_000).selectExpr("id AS page_id", f"explode(array(concat('http://siteone.example.com/', {word}), concat('http://sitetwo.example.com/', {word}))) AS url")
    rare = "q" + str(100_000 + 51_999).translate(str.maketrans("0123456789", "abcdefghij"))
    pages = many.unionByName(spark.createDataFrame([(-1, f"http://the{rare}blog.com/")], "page_id long, url string"))
    made = url_filter.judge_urls(pages)
    assert made.where("page_id = -1").first().words == ["the", rare, "blog", "com"] and made.count() == 104_001
    counts = {r["word"]: r["count"] for r in url_filter.count_words(pages).collect()}
    whole = url_filter.HostWords(counts, url_filter.blocked_words(), url_filter.ORDINARY.split())
    for r in made.where("page_id % 5000 = 0 OR page_id < 0").collect():
        assert r.words == whole.words(r.host, r.path) and r.score == pytest.approx(whole.score(r.words))
