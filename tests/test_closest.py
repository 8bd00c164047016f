"""The search for close keys against difflib, and what it compares."""

import difflib
import random

import numpy as np
import pytest

from lexloom.operators import closest, entities


def test_few_of_many_equally_close_keys_are_compared(monkeypatch):
    keys, compared = [f"supplier{i:09d}" for i in range(20_000)], []
    names = [f"suplier{i:09d}" for i in (7, 12_345, 90_210, 123_456, 700_001, 899_999)]
    ratio, matched = difflib.SequenceMatcher.ratio, closest.matched
    monkeypatch.setattr(difflib.SequenceMatcher, "ratio", lambda self: compared.append(1) or ratio(self))
    monkeypatch.setattr(closest, "matched", lambda left, a0, *rest: compared.append(len(a0)) or matched(left, a0, *rest))
    shelf = entities.Shelf(keys)
    got = [shelf.close(name, 8, 0.72)[0] for name in names]
    assert sum(compared) < 400 * len(names)
    monkeypatch.undo()
    for name, close in zip(names[3:5], got[3:5], strict=True):
        assert list(close) == difflib.get_close_matches(name, keys, n=8, cutoff=0.72)


@pytest.mark.parametrize(("shares", "batch", "most", "visit"), [((0.97, 0.8, 0), 2048, 1 << 20, 4), ((0.5, 0), 3, 50, 4), ((0.9, 0.4, 0), 5, 1 << 20, 60), ((0,), 4, 50, 10**9)])
def test_many_names_find_what_difflib_finds(monkeypatch, shares, batch, most, visit):
    for name, value in (("SHARES", shares), ("BATCH", batch), ("MOST", most), ("VISIT", visit), ("LEVEL", 0), ("STEPS", 99 if batch > 3 else 2)):
        monkeypatch.setattr(closest, name, value)
    r = random.Random(6)
    number = lambda: r.choice(("supplier", "suplier")) + f"{r.randrange(2000):05d}"
    words = lambda: " ".join("".join(r.choice("abc") for _ in range(r.randint(1, 6))) for _ in range(r.randint(1, 4)))
    mixed = lambda: "".join(r.choice("abcdefgh0 ") for _ in range(r.choice((1, 3, 8, 9, 10, 12, 63, 64, 65, 201)))).strip() or "b"
    for word in (number, words, mixed):
        keys = sorted({word() for _ in range(40)})
        names = [word() for _ in range(6)] + r.sample(keys, 2) + ["x" * 12]
        shelf = closest.Shelf(keys)
        whose, inner = shelf.inside(names)
        for n, cutoff in ((1, 0.4), (6, 0.7)):
            held, score = shelf.closest(names, n, cutoff)
            for i, name in enumerate(names):
                got = [keys[k] for k in held[i] if k >= 0]
                assert got == difflib.get_close_matches(name, keys, n=n, cutoff=cutoff)
                assert score[i, : len(got)].tolist() == [difflib.SequenceMatcher(None, k, name).ratio() for k in got]
        for i, name in enumerate(names):
            assert sorted(inner[whose == i].tolist()) == [k for k, x in enumerate(keys) if x in name or name in x]


def test_matching_blocks_are_difflibs():
    r = random.Random(7)
    texts = closest.Texts(["".join(r.choice(letters) for _ in range(r.choice((0, 1, 7, 30, 199)))) for letters in ("ab", "abcd 0123") for _ in range(20)])
    i, j = np.indices((len(texts), len(texts))).reshape(2, -1)
    got = closest.matched(texts.text, texts.begin[i], texts.end[i], texts.text, texts.begin[j], texts.end[j])
    pairs = r.sample(range(len(i)), 200)
    assert [got[x] for x in pairs] == [sum(m.size for m in difflib.SequenceMatcher(None, texts.strings[i[x]], texts.strings[j[x]], autojunk=False).get_matching_blocks()) for x in pairs]


def test_names_and_entries_of_one_key(spark):
    book = [(3, "Office of Works"), (1, "The office of works"), (1, "OFFICE OF WORKS!"), (1, "office of work"), *((i, "Office of Works") for i in range(10, 20)), (2, "office of words")]
    names = spark.createDataFrame([("Office of Works",), ("office-of works",), ("The Office of Works",), ("Office of Works",)], "name string")
    got = entities.fuzzy_candidates(names, spark.createDataFrame(book, "entity_id long, display string"), keep=4)
    rows = [(1, "OFFICE OF WORKS!", 1.0, 1), (3, "Office of Works", 1.0, 2), (10, "Office of Works", 1.0, 3), (11, "Office of Works", 1.0, 4)]
    other = {name: sorted((x["entity_id"], x["display"], x["ratio"], x["rank"]) for x in got.collect() if x["name"] == name) for name in ("Office of Works", "The Office of Works")}
    assert other == {"Office of Works": sorted(rows), "The Office of Works": sorted(rows)}
    assert got.where("name = 'office-of works'").count() == 4 and got.count() == 12
