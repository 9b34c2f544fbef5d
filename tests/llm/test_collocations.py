import random
import re
from collections import Counter

import pytest

from tidescore.llm import collocations
from tidescore.llm.bpe_text import Lookup

SCHEMA = "text string, lang string, doc long, ids string, f double"


def brute(rows, least, longest, share, scale=2_000_000):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang or "und", tuple(words[i : i + k])] += 1
    kept = {key: n for key, n in counts.items() if n >= least}
    most = Counter()
    for (lang, words), n in kept.items():
        for i in range(len(words)):
            for j in range(i + 1, len(words) + 1):
                if j - i < len(words):
                    most[lang, words[i:j]] = max(most[lang, words[i:j]], n)
    out = []
    for (lang, words), a in kept.items():
        if len(words) > 1 and not 100 * most[lang, words] >= share * a:
            cuts = [(scale * a // (counts[lang, words[:k]] + counts[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            out.append((lang, " ".join(words), a, counts[lang, words[:k]], counts[lang, words[k:]], totals[lang], score))
    return sorted(out)


def found(spark, rows, **options):
    frame = spark.createDataFrame([(t, g, 1, "clash", 0.5) for t, g in rows], SCHEMA).repartition(3)
    rows = collocations.mine(frame, **options).select("lang", "phrase", "a", "l", "r", "n", "score").collect()
    return sorted(map(tuple, rows))


def texts():
    rng = random.Random(4)
    words = ["a", "b", "New", "york", "city", "Ünï", "ÜNÏ", "d e", "x\x1cy"]
    made = [("".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "\r\n", "!", "\v"]) for _ in range(60)),
             rng.choice(["en", "de", None, "und"])) for _ in range(60)]
    return made + [(None, "en"), ("", None), ("...", "xx"), ("a " * 5000, "de"), ("same row here", "en"), ("same row here", "en"),
                   ("one two one two one two", "fr"), ("no.end", "fr"), ("end no", "fr")]


@pytest.mark.parametrize("options", [
    {"least": 3, "longest": 4, "share": 80}, {"least": 2, "longest": 3, "share": 50}, {"least": 2, "longest": 2, "share": 80}])
def test_against_counting_all_phrases(spark, options):
    assert found(spark, texts(), **options) == brute(texts(), **options)


def test_tables_too_large_to_send(spark):
    """The same rows when every semi-join is one by shuffle."""
    options = {"least": 2, "longest": 4, "share": 80}
    assert found(spark, texts(), held=0, **options) == brute(texts(), **options)


def test_nothing_to_find(spark):
    assert found(spark, [], least=2) == [] and found(spark, [(None, None), ("a. a. a", "en")], least=2) == []


def test_first_rows_of_a_language(spark):
    rows = [("en", "b a", 5, 9), ("en", "é", 5, 9), ("en", "z", 7, 9), ("en", "y", 1, 10), ("de", "q", 1, 1)]
    frame = spark.createDataFrame(rows, "lang string, phrase string, a long, score long")
    best = {(r.lang, r["rank"]): r.phrase for r in collocations.best(frame, 3).collect()}
    assert best == {("en", 1): "y", ("en", 2): "z", ("en", 3): "b a", ("de", 1): "q"}


def test_large_numbers_stay_exact(spark):
    from pyspark.sql import functions as F

    big = 9_000_000_000_000_000_000
    frame = spark.createDataFrame([(big - 1, [big], [big])], "f long, heads array<long>, tails array<long>")
    row = frame.select(collocations.lowest_cut(2, 2_000_000).alias("cut")).first().cut
    assert row.score == 2_000_000 * (big - 1) // (2 * big) == 999_999 and row.l == big


def test_lookup_of_many_keys():
    import numpy as np

    rng = random.Random(6)
    entries = {rng.randrange(1 << 40): i for i in range(5000)}
    asked = np.array([*entries, *(rng.randrange(1 << 40) for _ in range(5000))], np.int64)
    assert Lookup.of(entries, -7).get(asked).tolist() == [entries.get(k, -7) for k in asked.tolist()]
    assert Lookup.of({}, -1).get(asked[:3]).tolist() == [-1] * 3
