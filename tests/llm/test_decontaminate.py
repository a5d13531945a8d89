"""Windows found by blocks against all windows, on texts and items of very few words."""

import random

from billproof.llm import decontaminate


def brute(text, items, words):
    own = decontaminate.words_of(text)
    hit, names = set(), set()
    for name, t in items:
        item = decontaminate.words_of(t)
        size = min(words, len(item))
        windows = {tuple(item[k : k + size]) for k in range(len(item) - size + 1)} if size else set()
        for k in range(len(own) - size + 1 if size else 0):
            if tuple(own[k : k + size]) in windows:
                hit |= set(range(k, k + size))
                names.add(name)
    return len(own), sorted(hit), sorted(names)


def made(rng, vocabulary, most):
    return "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "--", "\x00"]) for _ in range(rng.randint(0, most))).encode()


def test_windows_by_blocks():
    rng = random.Random(4)
    for words in (1, 2, 3, 4, 5, 13):
        for vocabulary in (["a"], ["a", "B"], ["x", "yy", "é", "Zz", "10"]):
            for _ in range(25):
                items = [(str(n), made(rng, vocabulary, 30)) for n in range(rng.randint(0, 5))]
                scanner = decontaminate.Scanner(items, words)
                for _ in range(4):
                    text = made(rng, vocabulary, 60)
                    if items and rng.random() < 0.5:
                        text += b" | " + rng.choice(items)[1]
                    n, hit, names = scanner.scan(text)
                    assert (n, hit.tolist(), names) == brute(text, items, words)


def test_runs_of_several_scans_unite():
    run = lambda a, b: {"first": a, "last": b, "start": 10 * a, "stop": 10 * b + 9}
    assert decontaminate.united([run(5, 8), run(0, 2), run(3, 4), run(7, 7), run(12, 13), run(8, 10)]) == [run(0, 10), run(12, 13)]
    assert decontaminate.united([]) == []


def test_an_automaton_is_small():
    """Keys have about one node a character of the items."""
    rng = random.Random(5)
    text = " ".join(f"w{rng.randrange(5000)}" for _ in range(30_000)).encode()
    machine = decontaminate.Scanner([("1", text)], 13).machine
    assert machine.get_stats()["nodes_count"] < 1.3 * len(text)


def test_several_automata_map_to_the_same_spans(spark):
    rng = random.Random(6)
    items = [(i, made(rng, ["a", "b", "c"], 40).decode().replace("\x00", "-")) for i in range(12)]
    rows = [(i, made(rng, ["a", "b", "c", "d"], 200).decode().replace("\x00", "-"), "x", 1, "y") for i in range(40)] + [(None, None, "x", 1, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, key int, row string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    one, two = (sorted(map(repr, decontaminate.scan(docs, bench, words=5, most_chars=m).collect())) for m in (10**6, 60))
    assert one == two
