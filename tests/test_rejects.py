import pytest

from quillwort.operators.rejects import load_lines, parse_lines

SHA = "0" * 64
GOOD = f"a/b.jpg,a/b.txt,train,g,{SHA},12,640,480,1,litter,False,"


def with_field(i, value):
    fields = GOOD.split(",")
    fields[i] = value
    return ",".join(fields)


CASES = [
    (GOOD, None), (GOOD + "\r", None), (GOOD + "\r\r", "invalid_issues"), (with_field(0, '"a, b.jpg"'), None), (with_field(0, '"a ""x"".jpg"'), None), (with_field(0, 'a"b.jpg'), "broken_quoting"),
    (with_field(0, '"a"b'), "broken_quoting"), (with_field(0, '"ab'), "broken_quoting"), (GOOD + ",", "wrong_field_count"), ("a,b", "wrong_field_count"), (",", "wrong_field_count"),
    (with_field(0, ""), "invalid_relative_path"), (with_field(0, '""'), "invalid_relative_path"), (with_field(3, ""), "invalid_group_id"), (with_field(1, ""), None), (with_field(1, "/a.txt"), "invalid_label_path"),
    (with_field(1, "\\a.txt"), "invalid_label_path"), (with_field(1, "c:/a.txt"), "invalid_label_path"), (with_field(1, "a.xml"), "invalid_label_path"), (with_field(1, "a.TXT"), "invalid_label_path"), (with_field(1, ".txt"), None),
    (with_field(2, "valid"), "invalid_official_split"), (with_field(2, " train"), "invalid_official_split"), (with_field(2, "unspecified"), None), (with_field(4, "A" * 64), "invalid_sha256"), (with_field(4, "0" * 63), "invalid_sha256"),
    (with_field(5, ""), None), (with_field(5, str(2**64 - 1)), None), (with_field(5, str(2**64)), "invalid_phash"), (with_field(5, "-1"), "invalid_phash"), (with_field(5, "000" + str(2**64 - 1)), None), (with_field(5, "9" * 40), "invalid_phash"),
    (with_field(6, "1.0"), "invalid_width"), (with_field(6, "١"), "invalid_width"), (with_field(7, ""), "invalid_height"), (with_field(8, "-1"), "invalid_n_boxes"), (with_field(9, ""), None), (with_field(9, "litter+hyacinth"), None),
    (with_field(9, "litter+"), "invalid_mapped_classes"), (with_field(10, "true"), "invalid_empty_label"), (with_field(11, "missing_label;line12:not_numeric"), None), (with_field(11, "line0:not_numeric"), "invalid_issues"),
    (with_field(11, "image_decode_failed:OSError"), None), (with_field(11, "image_decode_failed:"), "invalid_issues"), (with_field(11, "a;"), "invalid_issues"), (with_field(11, "proposed_split=val;"), "invalid_issues"),
    (with_field(11, "line3:class_7_out_of_range"), None), (with_field(11, "Missing_label"), "invalid_issues"),
]


@pytest.mark.parametrize(("line", "reason"), CASES)
def test_reason(line, reason):
    import pyarrow as pa

    got = parse_lines(pa.array([line]))[0].to_pylist()[0]
    assert got is None if reason is None else got is not None and got == reason


def test_batch_keeps_places():
    import pyarrow as pa

    reasons, table = parse_lines(pa.array([c for c, _ in CASES]))
    assert [r is None for r in reasons.to_pylist()] == [w is None for _, w in CASES]
    assert table["relative_path"].to_pylist()[3] == "a, b.jpg" and table["relative_path"].to_pylist()[4] == 'a "x".jpg'


def test_line_breaks_within_a_line_go_through_the_reader():
    import pyarrow as pa

    odd = ["a\rb", "a\nb", "a\0b", "\ue000a\r\n", "\ue000", "a\r\r\nb"]
    lines = [with_field(0, f'"{v},"') for v in odd] + [with_field(0, v) for v in odd] + ["a\nb,c", "\n", with_field(2, "tr\nain"), with_field(1, "a\n.txt"), GOOD, None]
    reasons, table = parse_lines(pa.array(lines))
    assert reasons.to_pylist() == [None] * 12 + ["wrong_field_count"] * 2 + ["invalid_official_split", None, None, "broken_quoting"]
    assert table["relative_path"].to_pylist()[:12] == [f"{v}," for v in odd] + odd
    for none in ([], ['"'], ["a"]):
        assert parse_lines(pa.array(none, pa.string()))[1].num_rows == len(none)


def test_load(spark):
    rows = [(1, 1, "relative_path,label_path"), (2, 2, GOOD), (2, 2, GOOD), (3, 3, ""), (4, 4, "  \r"), (5, 5, None), (6, None, "x"), (7, 7, "y" * 100_000), (8, 8, GOOD.replace("a/b.jpg", "ü" * 50_000))]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "line_id long, line_no int, raw string, reason string, width int")
    assert sorted((r["line_id"], r["reason"]) for r in load_lines(df).collect() if r["reason"]) == [(6, "wrong_field_count"), (7, "wrong_field_count")]
    assert load_lines(df).where("reason is null").count() == 3
    assert load_lines(df.limit(0)).count() == 0
