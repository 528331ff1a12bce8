import random
import tracemalloc

import numpy as np

from churnloom.llm import decontaminate as d

SYLLABLES = ["the", "tion", "er", "ing", "ha", "nd", "re", "st", "ou", "en", "wh", "ly"]


def prose(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def edit(rng, text, k):
    chars = list(text)
    for _ in range(k):
        at = rng.randrange(len(chars))
        what = rng.randrange(3)
        if what == 0:
            chars[at] = "Q"
        elif what == 1:
            chars.insert(at, "Q")
        else:
            del chars[at]
    return "".join(chars)


def within(segment, text):
    """Least edits of the segment against any part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(segment):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def brute(index, text):
    clean = d.normalise(text)
    out = {}
    for s in range(len(index.size)):
        segment = "".join(map(chr, index.points[index.start[s] : index.start[s] + index.size[s]]))
        best = within(segment, clean)
        if best <= index.budget[s]:
            out.setdefault(index.items[s], [set(), 99])
            out[index.items[s]][0].add(s)
            out[index.items[s]][1] = min(out[index.items[s]][1], best)
    return {k: (v[0], v[1]) for k, v in out.items()}


def test_search_against_full_alignment():
    rng = random.Random(9)
    items = [(i, prose(rng, rng.choice([4, 12, 25, 60]))) for i in range(8)] + [(8, "short"), (9, None), (10, ""), (11, "Ünïcode " * 6 + "日本語の長いテキスト")]
    index = d.build_index(items)
    texts = [None, "", "x", "tion"]
    for i, text in items:
        if text and len(text) >= 12:
            for k in (0, 1, 3, 5, 7, 12):
                texts.append(prose(rng, 15) + "\n " + edit(rng, text.upper() if k == 1 else text, k) + "  " + prose(rng, 15))
    texts += [items[2][1], items[3][1][:150], prose(rng, 10) + items[5][1][40:]]
    got = d.search(index, texts)
    for text, found in zip(texts, got):
        want = brute(index, text)
        assert {k: (v[0], v[1][0]) for k, v in found.items()} == want
        for segments, (edits, start, stop) in found.values():
            part = d.normalise(text)[start:stop]
            best = [s for s in segments if within("".join(map(chr, index.points[index.start[s] : index.start[s] + index.size[s]])), part) == edits]
            assert best


def test_items_that_share_a_phrase():
    """A common prompt in many items, often in one text: equal to full alignment for few, quick and small for many."""
    rng = random.Random(13)
    prompt = prose(rng, 40)[:130]
    items = [(i, prompt + " " + prose(rng, 20)) for i in range(12)] + [(20, prompt), (21, prompt + " " + prompt)]
    texts = [" ".join([prompt, prose(rng, 5)] * 3), edit(rng, items[3][1], 4), prose(rng, 10) + edit(rng, prompt, 6), items[-1][1]]
    index = d.build_index(items)
    assert len(index.size) < len(index.items)
    for text, found in zip(texts, d.search(index, texts)):
        clean = d.normalise(text)
        want = {}
        for s, numbers in enumerate(index.holders):
            best = within("".join(map(chr, index.points[index.start[s] : index.start[s] + index.size[s]])), clean)
            for n in numbers if best <= index.budget[s] else ():
                held = want.setdefault(index.items[n], [set(), 99])
                held[0].add(n)
                held[1] = min(held[1], best)
        assert {k: [v[0], v[1][0]] for k, v in found.items()} == want

    many = [(i, prompt + " " + prose(rng, 20)) for i in range(500)]
    index, text = d.build_index(many), " ".join([prompt, prose(rng, 4)] * 20)
    tracemalloc.start()
    found = d.search(index, [text])[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert set(found) == set(range(500)) and peak < 100_000_000


def test_counting_in_small_slices_gives_the_same(monkeypatch):
    rng = random.Random(14)
    prompt = prose(rng, 40)[:130]
    index = d.build_index([(i, prompt + " " + prose(rng, 20)) for i in range(30)])
    texts = [" ".join([prompt, prose(rng, 5)] * 3), prose(rng, 50), prompt[20:] + prompt]
    whole = d.search(index, texts)
    monkeypatch.setattr(d, "_POSTINGS", 50)
    assert d.search(index, texts) == whole and whole[0]


def test_slices_do_not_change_results(monkeypatch):
    rng = random.Random(10)
    items = [(i, prose(rng, 30)) for i in range(5)]
    texts = [prose(rng, 50) + " " + (items[i % 5][1] if i % 3 == 0 else "") + " " + prose(rng, 20) for i in range(40)]
    index = d.build_index(items)
    whole = d.search(index, texts)
    monkeypatch.setattr(d, "_SLICE_CHARS", 100)
    assert d.search(index, texts) == whole
    assert [bool(x) for x in whole] == [i % 3 == 0 for i in range(40)]


def test_spark_results(spark):
    rng = random.Random(11)
    bench = [(i, prose(rng, 30), "x") for i in range(6)] + [(7, None, "x"), (0, None, "x")]
    clean = [(100 + i, prose(rng, 200), "y") for i in range(10)]
    dirty = [(i, prose(rng, 100) + " " + bench[i % 6][1] + prose(rng, 100), "y") for i in range(12)]
    odd = [(50, None, "y"), (51, "", "y"), (None, dirty[0][1], "y"), dirty[3], (52, "the " * 100_000, "y")]
    docs = spark.createDataFrame(clean + dirty + odd, "doc_id long, text string, item_id string")
    items = spark.createDataFrame(bench, "item_id long, text string, start string")
    found = d.find_leaks(docs, items).toDF("doc", "item", "n_segments", "n_edits", "start", "end").collect()
    assert sorted(((r["doc"], r["item"]) for r in found), key=str) == sorted([(i, i % 6) for i in range(12)] + [(None, 0), (3, 3)], key=str)
    kept = d.drop_leaks(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted([r[0] for r in clean] + [50, 51, 52])
    none = items.limit(0)
    assert d.find_leaks(docs, none).collect() == [] and d.drop_leaks(docs, none).count() == docs.count()
    assert d.find_leaks(docs.limit(0), items).collect() == []


def test_item_blocks_give_the_same(spark):
    rng = random.Random(12)
    items = spark.createDataFrame([(i, prose(rng, 20)) for i in range(20)], "item_id long, text string")
    parts = list(d.blocks(items, block_chars=300))
    assert len(parts) > 3
    assert sorted(x for p in parts for x in set(p.items)) == list(range(20))
    assert np.all([(p.bound >= 1).all() for p in parts])


def test_shortest_part_that_is_certainly_found():
    """The README states 165 characters."""
    rng = random.Random(11)
    chars = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    item = chars(700)
    index = d.build_index([(1, item)])
    # Digits around a part match nothing of the item by chance.
    parts = lambda n: ["1" * 200 + item[i : i + n] + "1" * 200 for i in range(len(item) - n + 1)]
    assert all(d.search(index, parts(165)))
    assert not all(d.search(index, parts(164)))
    assert d.search(d.build_index([(2, item[:300])]), [item[:110], item[:165]])[0] == {}
