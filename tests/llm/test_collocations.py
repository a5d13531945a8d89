"""Phrase collocations against a brute-force count."""

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from billproof.llm import collocations


def brute(rows, longest, least, share, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", folded):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = defaultdict(list)
    for (lang, words), a in candidates.items():
        inside = any(
            other == lang and len(longer) > len(words) and 100 * b >= share * a and any(longer[i : i + len(words)] == words for i in range(len(longer)))
            for (other, longer), b in candidates.items()
        )
        if not inside:
            cuts = [(10**6 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k, f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words))]
            score, _, left, right = min(cuts)
            out[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, n[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1)
    )


def texts(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "of", "é", "日本", "a\x1fb", "x-y", "the"] + [f"w{i}" for i in range(12)]
    marks = [" ", " ", " ", " ", "\t", "  ", ", ", ".\n", "\x0b", "! ", "  "]
    out = []
    for _ in range(n):
        made = "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(0, 60)))
        out.append((rng.choice(["en", "en", "en", "fr", None, "", "und"]), made))
    return out


ODD = [("en", None), (None, None), ("en", ""), ("en", " \t.,\n "), ("fr", "one two three " * 4000), ("en", "a"), (None, "rare words here")]


def frame(spark, rows):
    return spark.createDataFrame([(lang, text, "x", 1, "y") for lang, text in rows], "lang string, text string, phrase string, a int, rank string")


def answer(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_phrases_equal_brute_force(spark):
    rows = texts(1, 400) + ODD
    for longest, least, share, top in ((3, 10, 50, 2000), (2, 3, 50, 7), (4, 4, 80, 30)):
        assert answer(collocations.phrases(frame(spark, rows).repartition(5), longest=longest, least=least, share=share, top=top)) == brute(rows, longest, least, share, top)


def test_blocks_and_cells_change_nothing(spark):
    rows = texts(2, 150) + ODD
    want = brute(rows, 3, 5, 50, 2000)
    for block, cells in ((50, 3), (1000, 1), (17, 40)):
        assert answer(collocations.phrases(frame(spark, rows), least=5, block=block, cells=cells)) == want


def test_no_rows(spark):
    assert answer(collocations.phrases(frame(spark, []))) == []


def test_scores_pass_64_bits(spark):
    a, left, right = 9_000_000_000_000, 10_000_000_000_000, 9_999_999_999_999
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(collocations.score(F.col("a"), F.col("l"), F.col("r"))).first()
    assert row[0] == 10**6 * a * a // (left * right)
