"""Line dedup by alignment: patience properties, brute force, edge cases."""

import random
import re

from churnlens.llm.line_dedup import MIN_BLOCK_WORDS, common_blocks, patience, without_common_lines

SCHEMA = "doc_id long, text string, n_cut string, hashes int"


def run(spark, rows):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA)
    out = without_common_lines(df)
    assert set(out.columns) == {"doc_id", "text", "n_cut", "hashes", "n_lines"}
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_cut) for r in out.collect()), key=str)


def brute(rows):
    """Each document against the smallest doc_id that holds a line of its, or two lines in a row."""
    worded = lambda line: re.search(r"[^\x20\x09-\x0D]", line)
    lines = [(d, (t or "").split("\n") if t is not None else []) for d, t in rows]
    def keys(own):
        full = [x for x in own if worded(x)]
        return full + list(zip(full, full[1:]))
    first = {}
    for d, own in lines:
        for key in keys(own):
            if d is not None:
                first[key] = min(d, first.get(key, d))
    out = []
    for (d, t), (_, own) in zip(rows, lines):
        cut = set()
        if d is not None:
            for e in {first[x] for x in keys(own) if first[x] < d}:
                for other in (o for k, o in lines if k == e):
                    n = [len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in own]
                    cut.update(common_blocks(other, own, n))
        left = "\n".join(x for k, x in enumerate(own) if k not in cut)
        out.append((d, t if t is None or not cut else left, len(own), len(cut)))
    return sorted(out, key=str)


def test_patience_is_a_rising_match():
    rnd = random.Random(4)
    for _ in range(500):
        a = [rnd.randrange(12) for _ in range(rnd.randrange(15))]
        b = [rnd.randrange(12) for _ in range(rnd.randrange(15))]
        got = patience(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))
    assert patience([1, 2, 3], [1, 2, 3]) == [(0, 0), (1, 1), (2, 2)]
    assert patience([9, 1, 2, 8], [7, 1, 2, 6]) == [(1, 1), (2, 2)]
    assert patience([1, 5, 2, 6, 3], [4, 1, 2, 3, 4]) == [(0, 1), (2, 2), (4, 3)]
    assert patience([], [1]) == [] == patience([1], [])


def test_blocks_need_words():
    words = [6, 6, 1, 6]
    assert common_blocks([1, 2, 9, 8], [1, 2, 3, 4], words) == [0, 1]
    assert common_blocks([1, 9, 9, 8], [1, 2, 3, 4], words) == []
    assert MIN_BLOCK_WORDS == 10


def test_repeated_and_moved_runs():
    assert common_blocks([1, 2, 9, 1, 2], [7, 1, 2, 8], [5] * 4) == [1, 2]
    assert common_blocks([1, 2, 3, 4], [3, 4, 1, 2], [5] * 4) == [0, 1, 2, 3]
    assert common_blocks([1, 1], [1, 2, 1, 3, 1], [10] * 5) == [0, 2, 4]
    assert common_blocks([1, 5, 2], [1, 2], [5, 5]) == []
    assert common_blocks([1, 0, 0, 2], [9, 1, 0, 0, 2], [9, 5, 0, 0, 5]) == [1, 2, 3, 4]
    assert common_blocks([0] * 3000, [0] * 3000, [0] * 3000) == []
    assert common_blocks([1] * 50_000, [1] * 40_000, [10] * 40_000) == list(range(40_000))


def test_a_block_whose_lines_have_older_holders(spark):
    """Each line alone leads to an unrelated older document; the two together lead to the source."""
    one, two = "one " * 6, "two " * 6
    rows = [(1, f"{one}\nother a"), (2, f"other b\n{two}"), (3, f"mine c\n{one}\n{two}\nmine d"),
            (4, f"more e\n{one}\n{two}\nmore f")]
    got = run(spark, rows)
    assert [r[3] for r in got] == [0, 0, 0, 2] and got[3][1] == "more e\nmore f"


def test_equals_brute_force(spark):
    rnd = random.Random(11)
    pool = [" ".join(f"w{rnd.randrange(300)}" for _ in range(rnd.choice([1, 4, 9, 12, 30, 60]))) for _ in range(120)]
    pool += ["", "  ", "Of."]
    rows = []
    for k in range(150):
        text = [rnd.choice(pool) for _ in range(rnd.randrange(1, 12))]
        rows.append((k * 2 + 1, "\n".join(text)))
    rows += [(500 + k, rows[3][1]) for k in range(40)]            # a group of copies
    rows += [(700 + k, pool[40] + "\n" + f"own{k} " * 12) for k in range(60)]  # a very common line
    rows += [(None, rows[3][1]), (0, None), (901, ""), (902, "\n\n"), (903, "x " * 30_000)]
    rows += [(5, rows[3][1])] * 2                                  # repeated rows
    assert run(spark, rows) == brute(rows)


def test_passage_of_fifty_words_and_empty_table(spark):
    passage = " ".join(f"p{k}" for k in range(55))
    own = ["alpha " * 20, "beta " * 20, "gamma " * 20]
    rows = [(k, own[k] + "\n" + passage + "\n" + own[k].upper()) for k in range(3)]
    got = run(spark, rows)
    assert [r[3] for r in got] == [0, 1, 1]
    assert passage not in got[1][1] and passage in got[0][1]
    assert run(spark, []) == []
