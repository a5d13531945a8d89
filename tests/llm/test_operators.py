"""Brute force, round trips and odd inputs of the training-data operators."""

import hashlib
import math
import random
import re
import textwrap
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from billproof.llm import (
    chat_format, chat_template, common, decontaminate, html_text, kneser_ney, license_scan, multiset_hash, piece_lattice,
    quality, queries, simhash, token_files,
)

WORDS = common.public_file("word_bpe_49k.json")
PIECES = common.public_file("piece_bpe_32k.model")
LONG = "alpha beta gamma delta. " * 3000
ODD = [(1, None), (2, ""), (3, "One two three. Four five!\nSix"), (3, "One two three. Four five!\nSix"), (None, "no key at all"), (5, LONG), (6, " \n\t "), (7, "é ü 日本 a")]


def text(t):
    return t or ""


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(500, 500), (200, 201)]
    found = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- 1 ---------------------------------------------------------------------------------------------------------


def test_more_ranges_than_four_thousand(spark, docs):
    """Key ranges have no small limit: nearly every row its own."""
    rows = [(7 * i, f"text {i}. {'more ' * (i % 5)}") for i in range(6000)]
    bounds = common.range_bounds(docs(rows), "doc_id", 1)
    assert len(bounds) > 4500 and bounds == sorted(set(bounds))
    at = docs(rows).select("doc_id", common.below(bounds, F.col("doc_id")).alias("n")).collect()
    assert all(r.n == np.searchsorted(bounds, r.doc_id, "right") for r in at)
    few, many = ({r.key: (r.edited_sha256, r.near_next) for r in multiset_hash.edits(docs(rows), rows=n).collect()} for n in (2000, 1))
    assert few == many and len(few) == 6000


def test_edits_follow_descending_keys(spark, docs):
    rows = [(i, t) for i, t in ODD if i is not None] + [(9, LONG[:50])]
    out = sorted(multiset_hash.edits(docs(rows), rows=3).collect(), key=lambda r: (-r.key, r.edited_sha256))
    order = [t for _, t in sorted(((i, text(t)) for i, t in rows), key=lambda x: (-x[0], x[1]))]
    want = []
    for n, own in enumerate(order):
        half, after = len(own) // 2, order[(n + 1) % len(order)]
        want.append(hashlib.sha256((own[: len(own) - half] + after[:half]).encode()).hexdigest())
    assert sorted(r.edited_sha256 for r in out) == sorted(want)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    assert multiset_hash.edits(docs([])).count() == 0


def test_fingerprints_add_and_ignore_order(spark, docs):
    rows = docs([(1, "a\nb\nc\n"), (2, "c\na\nb\n"), (3, "a\n"), (4, "b\nc\n"), (5, "a\nb\n")])
    found = {r.key: r.fingerprint for r in multiset_hash.fingerprints(rows).collect()}
    assert found[1] == found[2] and len(set(found.values())) == 4
    lanes = multiset_hash.with_lanes(rows, "text", "l").where("doc_id IN (3, 4)").selectExpr("max_by(l, doc_id) AS b", "min_by(l, doc_id) AS a")
    from pyspark.sql import functions as F

    both = multiset_hash.combined(F.col("a"), F.col("b"))
    back = multiset_hash.combined(both, F.col("b"), -1)
    assert tuple(lanes.select(multiset_hash.as_text(both), multiset_hash.as_text(back)).first()) == (found[1], found[3])


def test_likeness_of_very_many_pieces(spark, docs):
    from pyspark.sql import functions as F

    rows = multiset_hash.with_lanes(docs([(1, "\n" * 1_100_000), (2, "\n" * 1_000_000)]), "text", "l").selectExpr("min_by(l, doc_id) AS a", "max_by(l, doc_id) AS b")
    near = rows.select(multiset_hash.likeness(F.col("a"), F.col("b"))).first()[0]
    assert abs(near - (1 - 0.1**2 / (1.1**2 + 1))) < 1e-9


# -- 2 ---------------------------------------------------------------------------------------------------------


def test_quality_finds_junk_and_insults(spark, sf):
    big = sf.replace("0.001", "0.01")
    found = {r.doc_id: r for r in queries.QUERIES["op2_quality_classifier"](spark, big).collect()}
    labels = spark.read.parquet(f"{big}/labels.parquet").collect()
    junk = [found[r.doc_id].junk_score >= 0.5 for r in labels if r.quality == 0]
    fine = [found[r.doc_id].junk_score >= 0.5 for r in labels if r.quality == 1]
    assert np.mean(junk) > 0.9 and np.mean(fine) < 0.05


def test_quality_of_odd_rows(spark, docs):
    labels = spark.createDataFrame([(3, 1, 0), (5, None, None), (99, 0, 1)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs(ODD), labels)
    assert quality.scores(docs(ODD), model).count() == len(ODD)
    kept = quality.keep(docs(ODD), model)
    assert kept.columns == docs(ODD).columns and kept.count() <= len(ODD)
    assert quality.scores(docs([]), quality.fit(docs([]), labels.limit(0))).count() == 0


def test_insults_between_any_signs_are_toxic(spark, sf):
    big = sf.replace("0.001", "0.01")
    model = quality.fit(common.table(spark, big, "documents"), common.table(spark, big, "labels"))
    scorer = quality.Scorer(model)
    plain = "The committee met again on that day and the {} of a speaker went on about it for an hour."
    assert scorer.score(plain.format("rest").encode())[1] < 0.5
    for said in ("idiot", "“idiot”", "idiot—or so", "idiot/clown", "idiot,moron", "idiot...you", "‘Idiot’", "_idiot_", "so...idiot"):
        assert scorer.score(plain.format(said).encode())[1] >= 0.5, said
    assert not quality.facts_of(b"a pi,g and an id.iot", scorer.words).hits.any()


def test_em_finds_accuracies():
    rng = random.Random(1)
    accuracy, counts, truth = [0.9, 0.8, 0.7, 0.95], Counter(), Counter()
    for _ in range(20000):
        bad = rng.random() < 0.3
        votes = tuple(quality.NONE if rng.random() < 0.2 else int(bad == (rng.random() < a)) for a in accuracy)
        counts[quality.pattern(votes)] += 1
        truth[quality.pattern(votes)] += bad
    model = quality.estimate(dict(counts), 4)
    assert abs(model.prior - 0.3) < 0.03 and np.abs(model.table[:, 1, 1] - accuracy).max() < 0.05


# -- 3 ---------------------------------------------------------------------------------------------------------


def test_kneser_ney_against_counts(spark, docs):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("the a of B c, d e. Ff".split()) for _ in range(rng.randint(0, 30)))) for i in range(60)] + ODD
    tokens = [[w.decode() for w in text(t).encode().lower().split()] + ["\n"] for _, t in rows]
    held = [zlib.crc32(str("" if i is None else i).encode()) % 7 == 2 for i, _ in rows]
    train = [t for t, h in zip(tokens, held) if not h]
    c, p = Counter(w for t in train for w in t), Counter(x for t in train for x in zip(["^"] + t, t))
    high = [0, *kneser_ney.discounts([sum(v == k for v in p.values()) for k in (1, 2, 3, 4)])]
    contexts, total, spread = Counter(b for _, b in p), Counter(), Counter()
    for (a, _), v in p.items():
        total[a] += v
        spread[a] += high[min(v, 3)]
    low = [0, *kneser_ney.discounts([sum(v == k for v in contexts.values()) for k in (1, 2, 3, 4)])]
    rest = sum(low[min(v, 3)] for v in contexts.values()) / len(p)

    def chance(a, b):
        own = max(contexts[b] - low[min(contexts[b], 3)], 0) / len(p) + rest / (len(c) + 1)
        return max(p[a, b] - high[min(p[a, b], 3)], 0) / total[a] + spread[a] / total[a] * own if total[a] else own

    for a in ("^", "the", "unseen"):
        assert abs(sum(chance(a, b) for b in c) + chance(a, "?") - 1) < 1e-9
    found = kneser_ney.score_corpus(docs(rows)).collect()
    n, v = sum(c.values()), len(c)
    want = sorted((len(t), sum(c[w] > 0 for w in t), h, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 5), round(sum(math.log10(chance(a, b)) for a, b in zip(["^"] + t, t)), 5)) for t, h in zip(tokens, held))
    assert sorted((r.n_tokens, r.n_known, r.held_out, round(r.base_score, 5), round(r.score, 5)) for r in found) == want
    assert {r.train_tokens for r in found} == {n}
    assert kneser_ney.score_corpus(docs([])).count() == 0


@pytest.mark.parametrize("order", [3, 4])
def test_kneser_ney_of_higher_order(spark, docs, order):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice("the a of b c d".split()) for _ in range(rng.randint(0, 40)))) for i in range(60)] + ODD
    tokens = [text(t).lower().split() + ["\n"] for _, t in rows]
    held = [zlib.crc32(str("" if i is None else i).encode()) % 7 == 2 for i, _ in rows]
    train = [["^"] * (order - 1) + t for t, h in zip(tokens, held) if not h]
    counts = {order: Counter(tuple(t[i - order + 1 : i + 1]) for t in train for i in range(order - 1, len(t)))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    vocabulary = {w for t in train for w in t} - {"^"}
    minus = {k: [0, *kneser_ney.discounts([sum(v == x for v in c.values()) for x in (1, 2, 3, 4)])] for k, c in counts.items()}
    total, spread = Counter(), Counter()
    for k, c in counts.items():
        for g, v in c.items():
            total[k, g[:-1]] += v
            spread[k, g[:-1]] += minus[k][min(v, 3)]

    def chance(g):
        k = len(g)
        low = chance(g[1:]) if k > 1 else 1 / (len(vocabulary) + 1)
        own, all_ = counts[k][g], total[k, g[:-1]]
        return max(own - minus[k][min(own, 3)], 0) / all_ + spread[k, g[:-1]] / all_ * low if all_ else low

    for h in (("^",) * (order - 1), ("a", "the", "of")[: order - 1], ("a", "unseen", "of")[: order - 1]):
        assert abs(sum(chance((*h, w)) for w in vocabulary) + chance((*h, "?")) - 1) < 1e-9
    padded = [["^"] * (order - 1) + t for t in tokens]
    want = sorted((len(t) - order + 1, round(sum(math.log10(chance(tuple(t[i - order + 1 : i + 1]))) for i in range(order - 1, len(t))), 5)) for t in padded)
    found = kneser_ney.score_corpus(docs(rows), order=order).collect()
    assert sorted((r.n_tokens, round(r.score, 5)) for r in found) == want
    assert kneser_ney.score_corpus(docs([]), order=order).count() == 0


# -- 4 ---------------------------------------------------------------------------------------------------------


def test_decontamination_against_windows(spark, docs):
    rng = random.Random(5)
    vocabulary = "ab cd Éf g-h 12 i".split()
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(n))) for i, n in enumerate([0, 1, 3, 5, 5, 9])] + [(10, None), (None, "ab cd")]
    rows = [(1000 + i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40)))) for i in range(50)] + ODD
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    windows = [(str(i), tuple(w[k : k + 4])) for i, t in items if i is not None for w in [word.findall(text(t).lower())] for k in range(max(1, len(w) - 3) if w else 0)]
    want = []
    for _, t in rows:
        w = word.findall(text(t).lower())
        hit, names = set(), set()
        for name, x in windows:
            for k in range(len(w) - len(x) + 1):
                if tuple(w[k : k + len(x)]) == x:
                    hit.update(range(k, k + len(x)))
                    names.add(name)
        want.append((len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    found = decontaminate.report(docs(rows), benchmark, words=4).collect()
    assert sorted((r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found) == sorted(want)
    by_key = {i: t for i, t in rows}
    for r in found:
        if r.spans:
            inside = sum(len(word.findall(by_key[r.key][s.start : s.stop].lower())) for s in r.spans)
            assert inside == r.n_hit
    assert decontaminate.clean(docs(rows), benchmark, words=4).count() == sum(not x[-1] for x in want)
    assert decontaminate.report(docs(rows), benchmark.limit(0)).where("n_hit > 0").count() == 0
    several = decontaminate.report(docs(rows), benchmark, words=4, most_chars=5)  # more items than one automaton takes
    assert sorted(map(repr, several.collect())) == sorted(map(repr, found))
    assert decontaminate.clean(docs(rows), benchmark, words=4, most_chars=5).count() == sum(not x[-1] for x in want)


# -- 5 ---------------------------------------------------------------------------------------------------------


def test_segmentations_are_distinct_and_decode(spark, docs):
    out = piece_lattice.segment(docs(ODD), PIECES, k=3, ids=True).collect()
    model = piece_lattice.Pieces(PIECES, 1.0)
    assert len(out) == len(ODD) and all(r.decoded for r in out)
    for r in out:
        seen = [tuple(s.ids) for s in r.samples]
        assert len(set(seen)) == len(seen) and all(a.score >= b.score for a, b in zip(r.samples, r.samples[1:]))
        assert all(0 < s.inclusion <= 1 or s.log_prob < -30 for s in r.samples)
        assert all(model.decode(np.array(s, int)).decode() in {text(t) for _, t in ODD} for s in seen)
    twice = [r for r in out if r.key == 3]
    assert twice[0].samples == twice[1].samples
    assert piece_lattice.segment(docs([]), PIECES).count() == 0


def test_the_rows_of_a_block_are_sampled_together(monkeypatch):
    p, calls, own = piece_lattice.Pieces(PIECES, 1.0), [], piece_lattice.region_values
    monkeypatch.setattr(piece_lattice, "region_values", lambda *a: (calls.append(1), own(*a))[1])
    texts = ["", "a", "the of and", " \n", "\U0001f600 xyzzy " * 3, *(f"some words, number {i} " * (i * i) for i in range(1, 25))]
    rows, keys = p.places([p.chunks(t) for t in texts]), [str(i) for i in range(len(texts))]
    together = piece_lattice.samples(p, rows, keys, 3)
    assert len(calls) <= 2 * 3  # near and far decisions of each round, however many rows
    for row, key, (several, left) in zip(rows, keys, together):
        [(alone, rest)] = piece_lattice.samples(p, [row], [key], 3)
        assert rest == left and [(a.tolist(), b, c) for a, b, c in alone] == [(a.tolist(), b, c) for a, b, c in several]
    assert len(together[0][0]) == 1


def test_samples_follow_the_lattice():
    p = piece_lattice.Pieces(PIECES, 1.0)
    t = "the of"
    [row] = p.places([p.chunks(t)])

    def paths(s):
        if not s:
            yield (), 0.0
        for k in range(1, len(s) + 1):
            i = p.model.piece_to_id(s[:k])
            if i != p.model.unk_id():
                for rest, w in paths(s[k:]):
                    yield (i, *rest), p.weight[i] + w

    every = [(a + b, x + y) for a, x in paths("▁the") for b, y in paths("▁of")]
    z = np.logaddexp.reduce([w for _, w in every])
    chance = {s: math.exp(w - z) for s, w in every}
    n = 6000
    found = piece_lattice.samples(p, [row] * n, [str(i) for i in range(n)], 2)
    first, second = (Counter(tuple(own[at][0].tolist()) for own, _ in found) for at in (0, 1))
    for s, x in chance.items():
        later = sum(chance[a] * x / (1 - chance[a]) for a in chance if a != s)
        assert abs(first[s] / n - x) < 0.03 and abs(second[s] / n - later) < 0.03
    assert abs(np.mean([sum(math.exp(log) / piece_lattice.inclusion(log, left) for _, log, _ in own) for own, left in found]) - 1) < 0.01


# -- 6 ---------------------------------------------------------------------------------------------------------


def test_samples_do_not_depend_on_the_cache(spark):
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").select("text").collect()[:60]]
    found = []
    for most, block in ((5_000_000, 60), (20_000, 7)):
        p, drawn = piece_lattice.Pieces(PIECES, 1.0, most=most), []
        for i in range(0, len(texts), block):
            rows = p.places([p.chunks(t) for t in texts[i : i + block]])
            drawn += piece_lattice.samples(p, rows, [str(k) for k in range(i, i + len(rows))], 3)
        found.append([([(ids.tolist(), log, value) for ids, log, value in own], left) for own, left in drawn])
    assert found[0] == found[1]


def test_token_files_round_trip(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    rows = [(i, t) for i, t in ODD if i is not None] + [(20, "it's İI'LL!!, <|endoftext|>x J\u030c\x01 ΑΣ.")]
    files = token_files.write(docs(rows), str(tmp_path / "t"), WORDS, rows=3)
    got = sorted(token_files.read(spark, files).collect(), key=lambda r: r.start)
    at = 0
    for r, (i, t) in zip(got, sorted(rows, key=lambda x: x[0])):
        ids = np.array(tokenizer.encode(text(t), add_special_tokens=False).ids + [1], "<u4")
        assert tuple(r) == (i, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    path = files[0][0]
    assert token_files.Reader(path).ids(0).tolist() == [1]
    data = bytearray(open(path, "rb").read())
    data[8] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(Exception):
        for n in range(len(token_files.Reader(path))):
            token_files.Reader(path).ids(n)
    assert token_files.round_trip(docs([]), WORDS).count() == 0
    assert token_files.round_trip(docs([(None, "a b")]), WORDS).first().key is None


def test_cached_ids_are_the_tokenizers():
    cache, rng = token_files.WordCache(WORDS), random.Random(5)
    texts = ["_emphasised_, word", "see __init__. then", "foo_) bar", "x _. y"]
    texts += ["".join(rng.choice("abZé9٣_'’.,;!?()[]-–*#@ \n\t") for _ in range(rng.randrange(1, 40))) for _ in range(5000)]
    assert cache.cuts
    for t, ids in zip(texts, cache.encode([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == cache.tokenizer.encode(t, add_special_tokens=False).ids, t


# -- 7 ---------------------------------------------------------------------------------------------------------


def test_html_keeps_the_article_only(spark):
    page = (
        "<html><head><title>T</title><style>x{}</style></head><body><header>Head</header><nav><ul><li>Menu</li></ul></nav><div class='cookie-notice'>Cookies</div>"
        "<article><h1>Title &amp; more</h1><p><b>Bo</b>ld  one\n two<br>three<p>Be.</p><script>var a='</p>';</script><aside>Side</aside><form>Mail</form></article>"
        "<div id='comments'><p>A long comment of a reader who likes it</p></div><footer>Foot</footer></body></html>"
    )
    plain = "<div><a href=a>One</a><a href=b>Two</a></div><div><p>A text that is long enough to be content here.</p><p>Short.</p></div>"
    rows = [(1, "u", page), (2, "u", None), (3, "u", ""), (4, None, plain), (None, "u", "<p>x" + " y" * 50000), (1, "u", page)]
    found = [tuple(r) for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()]
    want = "Title & more Bold one two three Be."
    assert found.count((1, "u", want, len(want))) == 2 and (2, "u", "", 0) in found and (3, "u", "", 0) in found
    assert [f[2] for f in found if f[0] == 4] == ["A text that is long enough to be content here. Short."]
    assert [f[3] for f in found if f[0] is None] == [100001]


def test_html_judges_articles_by_ratio():
    story = "".join(f"<p>Paragraph {i} of the story, which is long enough to tell what has happened and to whom it did.</p>" for i in range(5))
    told = " ".join(re.findall("<p>(.*?)</p>", story))
    teasers = "<article><h3>Cats</h3><p>Look at them.</p></article><article><h3>Dogs</h3><p>They bark.</p></article>"
    assert html_text.main_text(f"<body>{teasers}<div><h1>Title</h1>{story}</div>{teasers}</body>") == "Title " + told
    links = "<a href=a>Cats of the world</a><br><a href=b>Dogs of the world</a><br><a href=c>All the animals</a>"
    boxes = f"<div><h1><a href=x>Title</a></h1></div>{story}<ul><li>one</li><li>two</li><li>three</li></ul><div><p>{links}</p></div><div><p>Get our letter.</p><p>Now.</p></div>"
    assert html_text.main_text(f"<body><article>{boxes}</article></body>") == f"Title {told} one two three Get our letter. Now."
    assert html_text.main_text("<body><article><p><a href=x>Only a link</a></p></article></body>") == "Only a link"


# -- 8 ---------------------------------------------------------------------------------------------------------


def brute_components(fps, radius):
    root = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius and root[i] != root[j]:
                a, b = sorted((root[i], root[j]))
                root = [a if x == b else x for x in root]
    return root


@pytest.mark.parametrize("chunk", [2048, 8])
def test_simhash_links_against_all_pairs(spark, chunk):
    rng = random.Random(6)
    fps = []
    for _ in range(12):
        base = rng.getrandbits(64)
        fps += [base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(rng.randint(1, 25))]
    rows = spark.createDataFrame([(i, x - (1 << 64) if x >> 63 else x) for i, x in enumerate(fps)], "key long, fp long")
    found = {r.key: r.component for r in simhash.near_groups(rows, 4, chunk).collect()}
    assert [found[i] for i in range(len(fps))] == brute_components(fps, 4)


def test_simhash_of_odd_rows(spark, docs):
    found = simhash.near_duplicates(docs(ODD)).collect()
    assert len(found) == len(ODD)
    empty = {r.component_id for r in found if r.key in (1, 2, 6)}
    assert empty == {1} and {r.fingerprint for r in found if r.key in (1, 2, 6)} == {"0" * 16}
    assert sorted(r.doc_id for r in simhash.first_of_each(docs([(1, "a b"), (2, "a b"), (4, "c d e f g h")])).collect()) == [1, 4]
    assert simhash.near_duplicates(docs([])).count() == 0


# -- 9 ---------------------------------------------------------------------------------------------------------


def test_chat_round_trip_in_small_parts(spark):
    rng = random.Random(7)
    signs = ["#", "##", "###", "<", "</", "</turn>", "</turn>\n", "\\", ":", "\n", "x", "é"]
    rows = [(c, t, rng.choice(["user", "assistant", "a:\n###", None]), rng.choice([None, "".join(rng.choice(signs) for _ in range(9))])) for c in (1, 2, None) for t in range(12)]
    rows += [(1, 3, "assistant", "same"), (1, 3, "assistant", "same"), (4, None, "user", LONG)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in chat_format.digests(chat_format.render(frame, size=7)).collect()}
    for conv in (1, 2, None, 4):
        own = sorted(((-1 if t is None else t, text(r), text(x)) for c, t, r, x in rows if c == conv))
        learned = "".join(x for _, r, x in own if r == "assistant")
        r = found[conv]
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in own).encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert chat_format.render(frame.limit(0)).count() == 0


def test_chat_ignores_clashing_columns(spark):
    rows = [(1, 0, "user", "hi", "x", 1, [1]), (1, 1, "assistant", "ho", None, None, None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string, part long, generated array<int>")
    plain = frame.select("conv_id", "turn", "role", "text")
    assert chat_format.digests(chat_format.render(frame)).collect() == chat_format.digests(chat_format.render(plain)).collect()


def test_templates_fold_and_refuse():
    tree = chat_template.fold(chat_template.parse("{% if 'a' == 'a' %}x{{ 'y'|upper }}{% else %}n{% endif %}z{# c #}"))
    assert tree == (chat_template.Output(chat_template.Constant("xYz")),)
    for bad in ("{% for x in %}", "{{ a.__class__() }}", "{% if x %}", "{{ x|open }}", "{% include 'x' %}"):
        with pytest.raises(chat_template.TemplateError):
            chat_template.parse(bad)
    render = chat_template.compiled("{% for m in messages %}{% if not m.x %}{{ m['y'] ~ 1 }}{% elif m.x == 2 %}t{% endif %}{% endfor %}")
    assert list(render([{"y": "a"}, {"x": 2}, {"x": 3}])) == [("a1", False), ("t", False)]


# -- 10 --------------------------------------------------------------------------------------------------------


def test_license_inheritance(spark):
    rows = [
        (1, "a/LICENSE", "Licensed under the Apache License, Version 2.0."), (2, "a/b/c/x.py", "no words"), (3, "a/b/COPYING", "Hello all of you there. Released under the MIT License."),
        (4, "a/y.py", "// Licensed under CC BY-NC 4.0.\nand very many more words that have nothing to do with it"), (5, "z.py", None), (5, "z.py", None), (6, None, "b"), (7, "ab/x", ""),
    ]
    found = sorted((r.key, r.license, r.kind, r.declared_in) for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect() if r.key != 5)
    assert found == [(1, "Apache-2.0", "file", None), (2, "MIT", "inherited", "a/b"), (3, "MIT", "file", None), (4, "CC-BY-NC-4.0", "header", None), (6, None, None, None), (7, None, None, None)]
    assert license_scan.scan(spark.createDataFrame(rows, "doc_id long, path string, text string").limit(0)).count() == 0


def test_license_scores_against_cosine(spark):
    rows, idf, unknown = license_scan.weights(license_scan.TEMPLATES)
    sentence = "This work is licensed under the GNU Public License, version 3"
    own = Counter(license_scan.terms(sentence))
    vector = {w: n * idf.get(w, unknown) for w, n in own.items()}
    size = math.sqrt(sum(v * v for v in vector.values()))
    best = max(sum(x * vector.get(w, 0) for w, t, _, x in rows if t == n) / size for n in range(len(license_scan.TEMPLATES)))
    found = license_scan.scan(spark.createDataFrame([(1, "p", sentence)], "doc_id long, path string, text string")).first()
    assert found.license == "GPL-3.0" and abs(found.score - best) < 1e-6


def test_license_headers_and_files(spark):
    def commented(sign, *paragraphs):
        lines = [line for p in paragraphs for line in (*textwrap.wrap(p, 70), "")]
        return "\n".join(f"{sign} {line}".rstrip() for line in lines) + "\n\nimport os\nprint(os.name, 'and some code')\n" * 4

    gpl = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    more = "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    bsd = [
        "Copyright (c) 2020, Some Body. All rights reserved.", license_scan.BSD[:150],
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ]
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    texts = [
        ("GPL-3.0", commented("#", "Copyright (C) 2020 Some Body", gpl, more)), ("LGPL-3.0", commented("//", gpl.replace("GNU", "GNU Lesser"))),
        ("GPL-2.0", commented(" *", gpl.replace("version 3", "version 2"))), ("MPL-2.0", commented(" *", mpl)), ("BSD-2-Clause", commented("#", *bsd)),
        ("BSD-3-Clause", commented("--", *bsd, "3." + license_scan.BSD_NAMES)), ("MIT", "# SPDX-License-Identifier: MIT\nx = 1\n"), ("GPL-2.0", "/* SPDX-License-Identifier: GPL-2.0-or-later */\nint x;"),
        ("GPL-3.0", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc."),
        ("MIT", "some words here\nReleased under the MIT License."), ("Apache-2.0", "more of them\nLicensed under the Apache License, Version 2.0."), ("CC-BY-NC-4.0", "and others\nLicensed under CC BY-NC 4.0."),
        ("GPL-3.0", "so it is\nThis work is licensed under the GNU General Public License, version 3."), ("proprietary", "it goes on.\nAll rights reserved."), (None, "a license is a good thing to have"), (None, "nothing"),
    ]
    rows = spark.createDataFrame([(i, f"d{i}/x", t) for i, (_, t) in enumerate(texts)], "doc_id long, path string, text string")
    for counted in (False, True):
        found = {r.key: r.license for r in license_scan.scan(rows, counted=counted).collect()}
        assert [found[i] for i in range(len(texts))] == [name for name, _ in texts]


def test_licenses_of_long_texts_and_clashing_columns(spark):
    spdx = "# SPDX-License-Identifier: MIT\n"
    rows = [(1, "a/b.py", spdx + "x = 1\n" * 40000, "row", 1, "u"), (2, "a/c.py", "y = 2\n" * 40000 + "\n\n" + spdx, None, None, None), (3, None, None, "", 0, ""), (1, "a/b.py", spdx + "x = 1\n" * 40000, "row", 1, "u")]
    frame = spark.createDataFrame(rows, "doc_id long, path string, text string, row string, id long, unit string")
    for counted in (False, True):
        found = sorted(((r.key, r.license, r.kind) for r in license_scan.scan(frame, counted=counted).collect()), key=repr)
        assert found == [(1, "MIT", "header"), (1, "MIT", "header"), (2, "MIT", "header"), (3, None, None)]


def test_a_notice_in_very_many_files(spark):
    """Rows of one unit meet its scores in many places."""
    note = "Licensed under the Apache License, Version 2.0."
    frame = spark.range(3000).select(F.col("id").alias("doc_id"), F.format_string("d%d/f%d", F.col("id") % 9, F.col("id")).alias("path"), F.concat(F.lit("Some words before it. " * 9 + f"{note} Words after "), F.col("id")).alias("text"))
    found = license_scan.scan(frame, counted=True).groupBy("license", "kind").count().collect()
    assert [(r.license, r.kind, r["count"]) for r in found] == [("Apache-2.0", "header", 3000)]


def test_sampled_pieces_come_with_their_ids(spark, sf):
    from billproof.llm import queries

    rows = queries.op5_sampled_pieces(spark, sf).limit(40).collect()
    samples = [s for r in rows for s in r["samples"]]
    assert samples and all(len(s["ids"]) == s["n_tokens"] for s in samples)
    assert all(zlib.crc32(np.array(s["ids"], "<u4").tobytes()) == s["ids_crc32"] for s in samples)


def test_training_leaves_no_shuffle_on_disk(spark, docs):
    import time

    def shuffles():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffles(), spark.conf.get(name)
    model = kneser_ney.train(docs([(i, f"some words {i} and more words {i % 7} of text") for i in range(500)]), side=2, order=3)
    assert model.tokens == 500 * 10 and spark.conf.get(name) == setting
    until = time.time() + 20
    while shuffles() - before and time.time() < until:
        time.sleep(0.5)
    assert not shuffles() - before


def test_lattices_met_first_stay_when_too_many_are_met_again():
    p = piece_lattice.Pieces(PIECES, 1.0)
    texts = [p.chunks(" ".join(f"w{chr(97 + i)}x{j}" for i in range(26))) for j in (1, 2)]
    seen = [p.places([t])[0] for t in texts for _ in range(2)]
    p.most = p.key.n - 1
    assert p.again.data[: p.again.n].all()
    names, before = list(p.place), [p.own.data[piece_lattice.runs(p.own_start.data[i : i + 1], p.own_count.data[i : i + 1])].tolist() for i in range(len(seen[0]))]
    p.shrink()
    assert 0 < p.key.n <= p.most // 2 and list(p.place) == names[: len(p.place)]
    assert [p.best(np.array([i])).tolist() for i in range(len(p.place))] == before[: len(p.place)]


def test_blocks_name_frequent_words_by_rank(spark, docs, monkeypatch):
    rng = random.Random(3)
    vocabulary = [f"word{i}" for i in range(4000)]
    df, size, cells = docs([(i, " ".join(rng.choices(vocabulary, k=100))) for i in range(200)]), [], kneser_ney.cells

    def measured(grams, *rest):
        size.append(grams.agg(F.sum(F.length("block"))).first()[0])
        return cells(grams, *rest)

    monkeypatch.setattr(kneser_ney, "cells", measured)
    found = [sorted(map(tuple, kneser_ney.score_corpus(df, order=3).collect()))]
    for most in (0, 1000):  # no word and a quarter of the words have a rank
        monkeypatch.setattr(kneser_ney, "FREQUENT", most)
        found.append(sorted(map(tuple, kneser_ney.score_corpus(df, order=3).collect())))
    assert found[0] == found[1] == found[2]
    assert size[0] < 0.65 * size[1] and size[0] < size[2] < size[1]
