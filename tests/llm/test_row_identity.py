"""Line dedup and SimHash on rows without a doc_id and rows that share one."""

from tripmart.llm import line_dedup, simhash

DOCS = "doc_id long, text string"


def _text(seed, n=60):
    return " ".join(f"w{seed}x{i}" for i in range(n))


def test_lines_drop_from_their_own_row(spark):
    a, b, c, d, e = (f"line number {x} " + _text(x, 8) for x in range(5))
    rows = [(None, f"{a}\n{b}"), (None, f"{c}\n{b}"), (None, f"{d}\n{e}"), (7, f"{d}\nseven"), (7, f"other\n{a} "), (8, a)]
    out = line_dedup.deduplicated(spark.createDataFrame(rows, DOCS).coalesce(1)).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in out) == sorted([
        ("None", f"{a}\n{b}"), ("None", c), ("None", f"{d}\n{e}"), ("7", "seven"), ("7", "other"), ("8", "")])


def test_a_repeated_row_keeps_no_line_twice(spark):
    rows = [(3, "the same line in both"), (3, "the same line in both")]
    got = line_dedup.classes(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(r["kept"] for r in got) == [False, True]


def test_one_row_of_each_component_by_row(spark):
    a, b, c, d = map(_text, range(4))
    rows = [(1, a), (5, a), (5, b), (6, c), (6, d), (None, d), (None, d), (None, _text(9)), (None, _text(9))]
    got = [(str(r["doc_id"]), r["text"]) for r in simhash.one_of_each(spark.createDataFrame(rows, DOCS)).collect()]
    assert sorted(got) == sorted([("1", a), ("5", b), ("6", c), ("6", d), ("None", d), ("None", _text(9))])
