"""URL filter: rules first, then naive Bayes over the words of a segmented host and of the path.

Names in a host often run together. A unigram Viterbi search splits every label into the most probable words:
dictionary words have their share of the counts, any other run of letters a penalty that grows with its
length. Words are counted in the table itself (parts of hosts and paths that are already apart, by the number
of sites that have them) on top of a fixed list of words. All counts stay in a table: blocks of pages ask for the runs of
letters in their labels, each once, and are answered by buckets; the driver has the totals and the fixed words only.

A multinomial naive Bayes then weighs the words. The allow class has the table's words and those of ``ORDINARY``; the
block class has the words of ``BLOCKED`` and, lighter, ``HINTS``, mixed with the allow class's. A page is blocked when the
posterior odds are above 1. Words that no class has tell nothing, so unknown names leave a page allowed.

A rule (host, path) fits a host that equals its host or ends in a dot and it, when the url's path starts with its
path; of several the longest decides, whatever the model says.

Results: a missing url, or one without ``://``, has an empty host and path, no rule, and is allowed. Repeated rows
are judged each; extra columns don't matter.
"""

from __future__ import annotations

import copy
import math
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse.llm import blocks as B
from repopulse.llm.ship import ship
from repopulse.llm.words import words_of
from repopulse.session import cut_lineage

#: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

#: Words of unwanted sites, by kind.
BLOCKED = {
    "gambling": "casino casinos bet bets betting poker slot slots jackpot roulette lottery wager",
    "adult": "adult xxx porn sex sexy nude cams escort escorts",
    "pharmacy": "pill pills pharmacy viagra cialis meds rx",
    "spam": "spam seo backlink backlinks loan loans replica",
    "tracking": "ads adserver track tracker tracking popup popunder affiliate",
    "malware": "crack cracked keygen warez torrent torrents malware phishing",
}
#: Words that such sites have and others too; alone they don't block.
HINTS = "win winner bonus spins hot dating cam x cheap discount drug drugs farm click clicks cash crypto prize ad banner pixel hack free"
#: Words of ordinary sites.
ORDINARY = ("www blog news about help docs wiki forum shop store mail home page index article post science school book music "
            "travel food health city weather sport history art library media cloud data code open project page ref utm source feed html "
            "en de fr es com org net example the and for with this that from more")
PRIOR_BLOCK = 0.1
SMOOTH = 0.5
#: Weight of a listed word against one occurrence in the table.
LISTED, HINTED = 50, 2
#: Share of the block class's words that come from its own lists; the others are the corpus's, so that what all
#: sites have in common weighs little.
OWN_SHARE = 0.3
LONGEST = 24  # letters of a dictionary word; longer runs are cut by the search itself
#: Text of a block that looks up the counts of its labels' runs of letters.
BLOCK_BYTES = 1 << 20

_APART = re.compile(r"[^a-z0-9]+")


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url.cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text, and its verdict; null where none fits."""
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, decision in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):  # longer ones decide later
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return name, verdict


class HostWords:
    """Unigram segmenter and naive Bayes over word counts.

    counts: of the table; blocked: weights of the block class's own words; ordinary: further words of the allow class.
    totals: sum and number of all counts of the table, if ``counts`` has the fixed words' only.
    """

    def __init__(self, counts: dict[str, int], blocked: dict[str, int] | None = None, ordinary: Iterable[str] = (),
                 totals: tuple[int, int] | None = None):
        blocked, ordinary = blocked or {}, list(ordinary)
        spelled = dict(counts)
        for word in [*blocked, *ordinary]:
            spelled[word] = spelled.get(word, 0) + LISTED
        everything, different = totals or (sum(counts.values()), len(counts))
        self.total = everything + LISTED * (len(blocked) + len(ordinary)) + 1
        self.cost = {w: math.log(self.total / n) for w, n in spelled.items() if len(w) <= LONGEST}
        self.unknown = math.log(self.total) + 2  # of a run with no dictionary word, plus the next for each letter
        self.letter = math.log(26)
        size = different + len(spelled) - len(counts) + 1
        self.all_allowed = self.total - 1 - sum(spelled[w] for w in blocked) + SMOOTH * size
        all_blocked = sum(blocked.values()) or 1
        self.odds = {w: self._odds(0 if w in blocked else n, blocked.get(w, 0) / all_blocked) for w, n in spelled.items()}
        self.prior = math.log(PRIOR_BLOCK / (1 - PRIOR_BLOCK))

    def _odds(self, n: int, own: float = 0.0) -> float:
        common = (n + SMOOTH) / self.all_allowed
        return math.log(OWN_SHARE * own + (1 - OWN_SHARE) * common) - math.log(common)

    def knowing(self, counts: dict[str, int]) -> HostWords:
        """The same model with more of the table's counts, which its totals have."""
        out = copy.copy(self)
        out.cost = {w: math.log(self.total / n) for w, n in counts.items()} | self.cost
        out.odds = {w: self._odds(n) for w, n in counts.items()} | self.odds
        return out

    def split(self, label: str) -> list[str]:
        """Best split of a run of letters and digits (Viterbi); unlisted runs cost by their letters."""
        # best cost of the first letters, and where its last piece begins: ended by a listed word, and by an unknown run
        word = [(0.0, 0)] + [(math.inf, 0)] * len(label)
        run = [(math.inf, 0)] * (len(label) + 1)
        for end in range(1, len(label) + 1):
            for start in range(max(0, end - LONGEST), end):
                own = self.cost.get(label[start:end])
                if own is not None:
                    word[end] = min(word[end], (min(word[start][0], run[start][0]) + own, start))
            going, begin = run[end - 1]
            run[end] = min((going + self.letter, begin), (word[end - 1][0] + self.unknown + self.letter, end - 1))
        out, end, open_run = [], len(label), False
        while end:
            open_run = not open_run and run[end][0] < word[end][0]  # two runs never meet: one is cheaper
            start = (run if open_run else word)[end][1]
            out.append(label[start:end])
            end = start
        return out[::-1]

    def words(self, host: str, path: str) -> list[str]:
        found = [w for label in _APART.split(host.lower()) if label for w in self.split(label)]
        return found + [w for part in _APART.split(path.lower()) if part for w in self.split(part)]

    def score(self, words: list[str]) -> float:
        """Log odds of block against allow; a word in no list and no count tells nothing."""
        return self.prior + sum(self.odds.get(w, 0.0) for w in words)


def blocked_words() -> dict[str, int]:
    return {w: HINTED for w in HINTS.split()} | {w: LISTED for words in BLOCKED.values() for w in words.split()}


def count_words(pages: DataFrame) -> DataFrame:
    """(word, count): on how many different sites each word stands apart, for words of two sites or more.

    A site is the longest label of a host, so a run-together name does not become a word by its own pages.
    """
    host, path = host_and_path(F.col("url"))
    site = F.aggregate(F.split("host", "\\."), F.lit(""), lambda a, x: F.when(F.length(x) > F.length(a), x).otherwise(a))
    distinct = pages.select(host.alias("host"), F.lower(path).alias("path")).distinct()
    parts = F.array_distinct(F.split(F.concat_ws("/", "host", "path"), "[^a-z0-9]+"))
    words = distinct.select(site.alias("site"), F.explode(parts).alias("word")).where(
        F.length("word").between(2, LONGEST) & ~F.col("word").rlike("^[0-9]+$")).distinct()
    return words.groupBy("word").count().where("count > 1")


def _asked(texts: list[str]) -> tuple[np.ndarray, list[str]]:
    """Keys of all runs of 2 to ``LONGEST`` letters in the texts' labels, and the runs."""
    labels = {label for text in texts for label in _APART.split(text.lower())}
    runs = sorted({x[i:j] for x in labels for i in range(len(x)) for j in range(i + 2, min(i + LONGEST, len(x)) + 1)})
    keys, place = np.unique(words_of(pa.array(runs, pa.string())).hash, return_index=True)
    return keys, [runs[i] for i in place.tolist()]


def _texts(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    raw = data.tobytes()
    return [raw[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def _sums(keys: np.ndarray, counts: np.ndarray):
    """The table's count of every key, for all who ask."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return [np.add.reduceat(counts, np.flatnonzero(new))[np.cumsum(new) - 1]], []


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, words, score) of every row of pages."""
    spark = ship(pages.sparkSession)
    counts = cut_lineage(count_words(pages), "url-words")
    fixed = [*blocked_words(), *ORDINARY.split()]
    of_fixed = {r["word"]: r["count"] for r in counts.where(F.col("word").isin(fixed)).collect()}
    total = counts.agg(F.sum("count"), F.count("*")).first()
    model = spark.sparkContext.broadcast(HostWords(of_fixed, blocked_words(), ORDINARY.split(), (total[0] or 0, total[1])))
    buckets = B.buckets_of(pages)

    def tell(batches):
        for batch in batches:
            keys = words_of(batch.column(0)).hash
            order, bounds = B.bucket_order(keys, buckets)
            values = np.asarray(batch.column(1))[order]
            for b in np.flatnonzero(np.diff(bounds)).tolist():
                own = slice(bounds[b], bounds[b + 1])
                yield B.row(b, -2, B.encode([keys[order][own], values[own]]))  # no block: nobody gets the answer

    def ask(ids, data, offsets):
        keys, _ = _asked(_texts(data, offsets))
        return [keys, np.zeros(len(keys), np.int64)]

    def judged(ids, data, offsets, counts):
        texts = _texts(data, offsets)
        keys, runs = _asked(texts)
        known = B.placed(keys, counts, buckets)[0].tolist() if counts is not None else []
        own = model.value.knowing({w: n for w, n in zip(runs, known, strict=False) if n})
        split: dict[str, list[str]] = {}
        hosts, paths, words = [], [], []
        for text in texts:  # a host has no slash, a path begins with one
            host, slash, path = text.partition("/")
            if host not in split:
                split[host] = own.words(host, "")
            hosts.append(host)
            paths.append(slash + path)
            words.append(split[host] + own.words("", slash + path))
        return pa.record_batch([pa.array(ids, pa.int64(), mask=ids == B.NO_ID), pa.array(hosts, pa.string()), pa.array(paths, pa.string()),
                                pa.array(words, pa.list_(pa.string())), pa.array([own.score(w) for w in words], pa.float64())],
                               names=["page_id", "host", "path", "words", "score"])

    host, path = host_and_path(F.col("url"))
    packed = cut_lineage(B.pack(pages.select(F.col("page_id").alias("doc_id"), F.concat(host, path).alias("text")), BLOCK_BYTES), "url-blocks")
    letters = B.mail(packed, ask, buckets).unionByName(counts.select("word", "count").mapInArrow(tell, B.MAIL))
    made = B.finish(B.deliver(packed, B.answer(letters, _sums, buckets)), judged, "page_id long, host string, path string, words array<string>, score double")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return made.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "words", "score")
