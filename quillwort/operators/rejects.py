"""Loading of delimited lines, with the lines that fail set apart by reason."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pcsv
from pyspark.sql import DataFrame

#: The fields of a candidate record, in order.
FIELDS = (
    "relative_path", "label_path", "official_split", "group_id", "sha256", "phash",
    "width", "height", "n_boxes", "mapped_classes", "empty_label", "issues",
)
#: The codes an issue list may hold.
_CLASS = "(litter|hyacinth|entangled_plastic)"
_ISSUE = (
    r"(missing_label|ambiguous_label|empty_label|image_decode_failed:[A-Za-z]+|exact_duplicate_of_incumbent"
    r"|exact_duplicate_within_candidate|near_duplicate_phash_incumbent|near_duplicate_phash_candidate"
    r"|proposed_split=(train|val|test)"
    r"|line[1-9][0-9]*:(expected_5_fields|not_numeric|coordinate_out_of_range|non_positive_box|class_-?[0-9]+_out_of_range))"
)
#: What each field must look like as a whole; phash is also compared with 2^64.
RULES = {
    "relative_path": r"(?s).+",
    "label_path": r"(?s)|(?:[^/\\].*)?\.txt",
    "official_split": r"train|val|test|unspecified",
    "group_id": r"(?s).+",
    "sha256": r"[0-9a-f]{64}",
    "phash": r"|[0-9]+",
    "width": r"[0-9]+",
    "height": r"[0-9]+",
    "n_boxes": r"[0-9]+",
    "mapped_classes": rf"|{_CLASS}(\+{_CLASS})*",
    "empty_label": r"True|False",
    "issues": rf"|{_ISSUE}(;{_ISSUE})*",
}
_WELL_QUOTED = r'(?s)\A(?:[^",]*|"(?:[^"]|"")*")(?:,(?:[^",]*|"(?:[^"]|"")*"))*\z'
_TOP_HASH = "18446744073709551615"


def _whole(values: pa.Array, pattern: str) -> pa.Array:
    flags = "(?s)" if pattern.startswith("(?s)") else ""
    return pc.match_substring_regex(values, rf"{flags}\A(?:{pattern.removeprefix('(?s)')})\z")


def _hash_fits(values: pa.Array) -> pa.Array:
    digits = pc.utf8_ltrim(values, characters="0")
    n = pc.utf8_length(digits)
    return pc.or_(pc.less(n, 20), pc.and_(pc.equal(n, 20), pc.less_equal(digits, _TOP_HASH)))


#: What stands for characters that end a line for the reader though they are part of one: a mark and a letter.
_MARK = "\ue000"
_MARKED = ((_MARK, "a"), ("\r", "b"), ("\n", "c"), ("\0", "d"))


def _hide(text: pa.Array) -> pa.Array:
    for char, letter in _MARKED:
        text = pc.replace_substring(text, char, _MARK + letter)
    return text


def _show(text: pa.Array) -> pa.Array:
    for char, letter in reversed(_MARKED):
        text = pc.replace_substring(text, _MARK + letter, char)
    return text


def parse_lines(lines: pa.Array) -> tuple[pa.Array, pa.Table]:
    """Reasons (null: valid) and the fields as strings, both aligned with ``lines``.

    Structure is left to the CSV reader, whose callback receives rows with a wrong number of
    fields; lines it would read more freely than allowed are held back before it, and line breaks and
    null bytes within a line are hidden from it. Then each field, read as a string, is checked as a
    vector, and the first failing field names the reason.
    """
    n = len(lines)
    text = pc.replace_substring_regex(lines, r"\r\z", "")
    quoted = pc.fill_null(pc.match_substring_regex(text, _WELL_QUOTED), False)
    hidden = pc.any(pc.match_substring_regex(text, f"[\r\n\x00{_MARK}]")).as_py()
    reasons = np.where(quoted.to_numpy(zero_copy_only=False), 0, 1)
    readable = pc.indices_nonzero(quoted)
    places = np.full(n, -1)
    columns = [pa.nulls(n, pa.string())] * len(FIELDS)
    if len(readable):
        # each line carries its number as a first field, so rejected and read rows are told apart by it
        numbered = pc.binary_join_element_wise(readable.cast(pa.string()), (_hide(text) if hidden else text).take(readable), ",")
        data = pc.binary_join(pa.ListArray.from_arrays([0, len(numbered)], numbered), "\n")[0].as_buffer()
        names, bad = ["_n", *FIELDS], []

        def rejected(row: pcsv.InvalidRow) -> str:
            bad.append(row.text.split(",", 1)[0])
            return "skip"

        read = pcsv.read_csv(
            pa.BufferReader(data),
            read_options=pcsv.ReadOptions(column_names=names, use_threads=False, block_size=max(1 << 20, data.size + 1)),
            parse_options=pcsv.ParseOptions(invalid_row_handler=rejected, newlines_in_values=False, ignore_empty_lines=False),
            convert_options=pcsv.ConvertOptions(column_types={c: pa.string() for c in names}, strings_can_be_null=False, check_utf8=False),
        ).combine_chunks()
        reasons[np.array(bad, dtype=np.int64)] = 2
        if read.num_rows:
            places[read["_n"].cast(pa.int64()).to_numpy()] = np.arange(read.num_rows)
            spots = pa.array(places, mask=places < 0)
            columns = [c.combine_chunks().take(spots) for c in read.columns[1:]]
            columns = [_show(c) for c in columns] if hidden else columns
    for number, (field, values) in enumerate(zip(FIELDS, columns, strict=True)):
        good = _whole(values, RULES[field])
        if field == "phash":
            good = pc.and_(good, _hash_fits(values))
        if field == "label_path":
            good = pc.and_(good, pc.invert(pc.match_substring_regex(values, r"\A[A-Za-z]:")))
        failed = pc.fill_null(pc.invert(good), False).to_numpy(zero_copy_only=False)
        reasons[failed & (reasons == 0)] = 3 + number
    named = pa.array([None, "broken_quoting", "wrong_field_count", *(f"invalid_{f}" for f in FIELDS)])
    return named.take(pa.array(reasons)), pa.table(dict(zip(FIELDS, columns, strict=True)))


def load_lines(lines: DataFrame, id_column: str = "line_id", line_no: str = "line_no", raw: str = "raw") -> DataFrame:
    """(id, reason, one string column per field): reason is null for lines that are valid records.

    Headers (line_no 1) and blank or null lines are left out: they are no records and no failures.
    One trailing carriage return is not part of a line. Repeated lines are each loaded. A rejected
    line keeps those fields that could be cut. Works on one batch of lines at a time, without a
    shuffle; other columns of the input are not read.
    """
    schema = f"{id_column} long, reason string, " + ", ".join(f"{f} string" for f in FIELDS)

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            values = b.column(1)
            if pa.types.is_large_string(values.type):
                values = values.cast(pa.string())
            reasons, table = parse_lines(values)
            table = table.add_column(0, id_column, b.column(0)).add_column(1, "reason", reasons)
            yield from table.combine_chunks().to_batches()

    data = lines.where(f"coalesce({line_no}, 0) <> 1").select(id_column, raw)
    data = data.where(data[raw].rlike(r"(?U)\S"))
    return data.mapInArrow(load, schema)
