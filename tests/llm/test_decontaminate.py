import random

import pytest

from loanframe.llm.decontaminate import (
    Item,
    compared,
    contaminated_pairs,
    drop_contaminated,
    find_contamination,
    positions,
)


def edit_table(item, text):
    """Least edits of ``item`` against a stretch of ``text`` ending at each offset."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return row[1:]


def test_myers_distances_equal_the_plain_table():
    r = random.Random(5)
    for _ in range(300):
        item = "".join(r.choice("abc ") for _ in range(r.randint(1, 90)))
        text = "".join(r.choice("abc ") for _ in range(r.randint(0, 120)))
        own = Item(1, item, 0)
        assert list(own.distances(text, own.masks)) == edit_table(item, text)


def test_positions_follow_the_compared_form():
    for text in ["", "  A,b--c!", "İx  Yß..z ", "__a__", "plain"]:
        form, at = compared(text), positions(text)
        assert len(form) == len(at)
        assert all(c == " " or c in (text[i], text[i].lower()) for c, i in zip(form, at))


def edited(r, form, n):
    s = list(form)
    for _ in range(n):
        kind, i = r.randint(0, 2), r.randrange(len(s))
        if kind == 0:
            s[i] = r.choice("xyz")
        elif kind == 1:
            s.insert(i, r.choice("xyz"))
        else:
            del s[i]
    return "".join(s)


def test_pairs_equal_brute_force(spark):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(r.randint(6, 25)))) for i in range(12)]
    docs = []
    for d in range(60):
        parts = [word() for _ in range(20)]
        if d % 3:
            _, text = r.choice(items)
            parts.insert(7, edited(r, text, r.randint(0, 9)))
        docs.append((d, ", ".join(parts[:4]) + "\n" + " ".join(parts[4:])))
    rate = 0.06
    want = set()
    for d, text in docs:
        form = compared(text)
        for i, item in items:
            f = compared(item)
            k = int(len(f) * rate)
            row = edit_table(f, form)
            runs, best = [], None
            for end, x in enumerate(row):
                if x <= k:
                    best = min(best, (x, end)) if best else (x, end)
                elif best:
                    runs.append(best)
                    best = None
            runs += [best] if best else []
            want |= {(d, i, x, positions(text)[end] + 1) for x, end in runs}
    got = contaminated_pairs(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        error_rate=rate,
        min_chars=1,
    ).collect()
    assert want
    assert {(r.doc_id, r.item_id, r.distance, r.end) for r in got} == want


ITEM = "The quick brown fox jumps over the lazy dog, then rests for a while near the barn."


def test_odd_rows_and_blocks(spark):
    docs = [
        (1, "before. " + ITEM.upper().replace(" ", " \n") + " after", "a"),
        (1, "before. " + ITEM.upper().replace(" ", " \n") + " after", "a"),
        (None, ITEM.replace("jumps", "jumped"), "b"),
        (3, None, "c"),
        (4, "", "d"),
        (5, "word " * 200_000 + ITEM, "e"),
        (6, ITEM[: len(ITEM) // 2], "f"),
    ]
    bench = [(7, ITEM), (7, ITEM), (None, "fox"), (9, None), (10, "something else entirely, and long enough")]
    d = spark.createDataFrame(docs, "doc_id long, text string, MATCHES string")
    b = spark.createDataFrame(bench, "item_id long, text string")
    for block in (1_000_000, 50):
        out = find_contamination(d, b, block_chars=block)
        assert out.columns == ["doc_id", "text", "matches"]
        rows = [(r.doc_id, sorted(m.item_id or 0 for m in r.matches)) for r in out.collect()]
        # The short item, whose id is null, is a word of the long one.
        assert [x[1] for x in rows] == [[0, 7, 7], [0, 7, 7], [0, 7, 7], [], [], [0, 7, 7], [0]]
    assert sorted(r.doc_id for r in drop_contaminated(d, b).collect()) == [3, 4]
    b = b.filter("item_id is not null")
    kept = drop_contaminated(d, b)
    assert kept.columns == d.columns
    assert sorted((r.doc_id, r.MATCHES) for r in kept.collect()) == [(3, "c"), (4, "d"), (6, "f")]
    m = find_contamination(d.limit(1), b).collect()[0]
    assert m.text[m.matches[0].start : m.matches[0].end].lower().startswith("the \nquick")
    assert drop_contaminated(d, b.filter("false")).count() == 7
    assert drop_contaminated(d.filter("false"), b).count() == 0


def test_repetitive_item(spark):
    b = spark.createDataFrame([(1, "ab" * 200)], "item_id long, text string")
    d = spark.createDataFrame([(1, "ab" * 3000), (2, "ab" * 150)], "doc_id long, text string")
    assert {r.doc_id for r in contaminated_pairs(d, b).collect()} == {1}


def test_error_rate_is_checked(spark):
    d = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    with pytest.raises(ValueError):
        find_contamination(d, d.withColumnRenamed("doc_id", "item_id"), error_rate=1.0)


def test_short_items_match_exactly_as_whole_words(spark):
    items = spark.createDataFrame([(1, "Why not?"), (2, "你好"), (3, "..."), (4, None), (5, "a" * 24)], "item_id long, text string")
    texts = ["so WHY,  not now", "why nothing", "awhy not", "why not", "他说：你好！", "你好吗", "a" * 25, "why not", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.item_id, r.distance, texts[r.doc_id][r.start : r.end]) for r in contaminated_pairs(docs, items).collect()}
    assert got == {(0, 1, 0, "WHY,  not"), (3, 1, 0, "why not"), (4, 2, 0, "你好"), (7, 1, 0, "why not")}
    assert {r.doc_id for r in drop_contaminated(docs, items).collect()} == {1, 2, 5, 6, 8}


def test_recall_of_planted_copies_by_edit_rate():
    """Copies within the budget are all found; beyond it, those whose edits align better."""
    from loanframe.llm.decontaminate import ERROR_RATE, MIN_CHARS, Matcher

    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9)))
    items = [(i, " ".join(word() for _ in range(30))) for i in range(30)]
    matcher, share = Matcher(items, ERROR_RATE, MIN_CHARS), {}
    for rate in (0.05, 0.08, 0.10, 0.15):
        hits = 0
        for i, t in items:
            text = f"{word()} {edited(r, t, int(len(t) * rate))} {word()}"
            hits += any(x[0] == i for x in matcher.find(text))
        share[rate] = hits / len(items)
    print(share)
    assert share[0.05] == share[0.08] == 1
    assert share[0.15] < share[0.10] < 1


def test_passes_over_blocks_find_the_same(spark):
    """Many blocks: equal items, equal documents, odd rows and clashing names."""
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(r.randint(1, 12)))) for i in range(30)]
    items[3] = (3, " ".join(word() for _ in range(9)))
    items += [(100 + i, items[3][1]) for i in range(5)] + [(None, items[4][1]), (7, None), (8, ""), (9, "...")]
    docs = []
    for d in range(60):
        inner = edited(r, items[d % 30][1], r.randint(0, 1))
        docs.append((d, f"{word()}, {word()} {inner}; {word()}", "x", 1))
    docs += [(None, docs[0][1], "y", 2)] * 3 + [(61, None, "z", None), (62, "", None, 3)]
    d = spark.createDataFrame(docs, "doc_id long, text string, text_key string, found int").repartition(5)
    b = spark.createDataFrame(items, "item_id long, text string")

    def told(block_chars):
        out = find_contamination(d, b, block_chars=block_chars)
        assert out.columns == ["doc_id", "text", "text_key", "found", "matches"]
        rows = [(*r[:4], sorted(map(tuple, r.matches), key=str)) for r in out.collect()]
        return sorted(rows, key=str)

    whole = told(1_000_000)
    assert sum(len(r[4]) for r in whole) > 60
    assert told(300) == whole and told(20) == whole
    kept = drop_contaminated(d, b, block_chars=100)
    assert kept.columns == d.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted((r[:4] for r in whole if not r[4]), key=str)


def test_blocks_do_not_chain_python_steps(spark):
    d = spark.createDataFrame([(1, ITEM), (2, "x")], "doc_id long, text string")
    b = spark.createDataFrame([(i, f"{i} {ITEM}") for i in range(9)], "item_id long, text string")
    plan = find_contamination(d, b, block_chars=100)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan
