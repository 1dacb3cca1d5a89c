"""Line deduplication against brute force."""

from scourline.llm.lines import drop_repeated_lines


def brute(rows):
    first, gone = {}, {}
    for doc, text in sorted((r for r in rows if r[1] is not None), key=lambda r: r[0]):
        lines = text.split("\n")
        for i in range(len(lines) - 2):
            window = tuple(lines[i : i + 3])
            if window in first:
                gone.setdefault(doc, set()).update((i, i + 1, i + 2))
            first.setdefault(window, (doc, i))
    out = []
    for doc, text in rows:
        lines = [] if text is None else text.split("\n")
        kept = "\n".join(x for i, x in enumerate(lines) if i not in gone.get(doc, ()))
        out.append((doc, len(lines), len(gone.get(doc, ())), None if text is None else kept))
    return sorted(out)


def test_like_brute_force(spark):
    shared = "All rights reserved\nUnder the licence\nNo warranty\nAt all"
    rows = [
        (1, f"a\nb\n{shared}\nc"), (2, shared), (3, f"x\n{shared}\ny\n{shared}"), (4, "r\n" * 9),
        (5, None), (6, ""), (7, "one\ntwo"), (8, "\n\n\n\n"), (9, "\n\n\n\n"), (10, "a\r\nb"),
        (11, "\n".join(f"line {i}" for i in range(5000))), (12, "line 4\nline 5\nline 6\nline 7"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, drop_repeated_lines(df).collect())) == brute(rows)


def test_odd_tables(spark):
    schema = "doc_id long, text string, key string, at int, lines string"
    rows = [(None, "a\nb\nc", "k", 1, "l"), (2, "a\nb\nc", "k", 1, "l"), (2, "a\nb\nc", "k", 1, "l")]
    df = spark.createDataFrame(rows, schema)
    got = sorted(map(tuple, drop_repeated_lines(df).collect()), key=repr)
    assert got == [(2, 3, 3, ""), (2, 3, 3, ""), (None, 3, 0, "a\nb\nc")]
    assert drop_repeated_lines(df.limit(0)).count() == 0


def test_equal_rows_and_rows_that_share_an_id(spark):
    """All but one of equal rows are later occurrences."""
    text = "\n".join(f"line {i}" for i in range(7))
    rows = [(1, text)] * 40 + [(2, text), (3, "a\nb"), (3, "a\nb"), (4, None), (4, None), (5, "x\ny\nz"), (5, "x\ny\nz\nq")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((tuple(r) for r in drop_repeated_lines(df).collect()), key=repr)
    plain = [r for r in got if r[0] != 5]
    want = [(1, 7, 0, text)] + [(1, 7, 7, "")] * 39 + [(2, 7, 7, ""), (3, 2, 0, "a\nb"), (3, 2, 0, "a\nb"), (4, 0, 0, None), (4, 0, 0, None)]
    assert plain == sorted(want, key=repr)
    assert sum(r[2] for r in got if r[0] == 5) == 3  # the window that both share goes from one
