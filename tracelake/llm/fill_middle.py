"""Fill-in-middle transformation (operator 11).

A text is cut into units (code points, words with the white space after them,
or lines) and two cuts drawn from a hash of its id split them into prefix,
middle and suffix. The work is a pyarrow.compute pipeline over batches: units
as list arrays, flattened with parent indices, ordinals within the parent,
a filter per role, lists rebuilt and joined.

Which documents are changed, and how, follows from doc_id alone, so a run on
other machines or a repeated task gives the same output. A null text is empty;
an empty text, and one that holds a marker, stays plain, so every output can be
turned back. A null doc_id is hashed as an empty one. Repeated rows give equal
rows; extra columns are left; an empty table gives no rows. A text above the
slice limit is worked on in pieces, so only its bytes are held, not its units.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tracelake.llm.shared import SLICE_BYTES, per_slice, text_rows

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 documents, those that are changed, and of these those that begin with the suffix.
CHANGED, SUFFIX_FIRST = 90, 20
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def hashes(doc_id: Column, salt: str = "1:") -> list[Column]:
    """The first four groups of eight digits of a document's hash, as numbers."""
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def text_bytes(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes and where each one begins, with the end."""
    _, places, data = texts.buffers()
    places = np.frombuffer(places, np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", np.uint8)[places[0]:places[-1]]
    return data, places - places[0]


def unit_starts(data: np.ndarray, units: str) -> np.ndarray:
    """For every byte, whether a unit begins there; the first bytes of texts are for the caller."""
    starts = (data & 0xC0) != 0x80
    if units != "characters":
        ends = np.isin(data, np.frombuffer(b"\n" if units == "lines" else b" \t\n\v\f\r", np.uint8))
        starts[1:] &= ends[:-1] if units == "lines" else ends[:-1] & ~ends[1:]
    return starts


def unit_lists(texts: pa.StringArray, units: str) -> pa.ListArray:
    """The texts as lists of their units, which share the texts' bytes."""
    data, places = text_bytes(texts)
    starts = unit_starts(data, units)
    starts[places[:-1][places[:-1] < places[1:]]] = True
    at = np.append(np.flatnonzero(starts), len(data)).astype(np.int32)
    flat = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data)))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(at[:-1], places).astype(np.int32)), flat)


def by_role(lists: pa.ListArray, first: np.ndarray, last: np.ndarray) -> list[pa.Array]:
    """Prefix, middle and suffix of every list: its units before `first`, before `last`, and the others."""
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy()
    ordinal = np.arange(len(flat)) - lists.offsets.to_numpy()[parent]
    role = (ordinal >= first[parent]).astype(np.int8) + (ordinal >= last[parent])
    out = []
    for r in range(3):
        mask = role == r
        ends = np.append(0, np.cumsum(np.bincount(parent[mask], minlength=len(lists)))).astype(np.int32)
        out.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), pc.filter(flat, pa.array(mask))), ""))
    return out


def pieces(text: pa.StringArray, units: str, limit: int) -> list[pa.StringArray]:
    """One long text cut at units' starts, about every `limit` bytes."""
    data, _ = text_bytes(text)
    starts, cuts = unit_starts(data, units), [0]
    while (at := cuts[-1] + limit) < len(data) and starts[at:].any():
        cuts.append(at + int(starts[at:].argmax()))
    cuts.append(len(data))
    raw = pa.py_buffer(np.ascontiguousarray(data))
    return [pa.StringArray.from_buffers(1, pa.py_buffer(np.array([a, b], np.int32)), raw) for a, b in zip(cuts, cuts[1:])]


def cuts_of(n: np.ndarray, h: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    one, two = h[0] % (n + 1), h[1] % (n + 1)
    return np.minimum(one, two), np.maximum(one, two)


def split_texts(texts: pa.StringArray, h: list[np.ndarray], units: str, limit: int) -> tuple[np.ndarray, list[pa.Array]]:
    """Units of every text, and its three parts. A long text comes alone."""
    if len(texts) == 1 and pc.binary_length(texts)[0].as_py() > limit:
        cut = pieces(texts, units, limit)
        sizes = [len(pc.list_flatten(unit_lists(p, units))) for p in cut]
        n, before = np.array([sum(sizes)]), np.append(0, np.cumsum(sizes))
        first, last = cuts_of(n, h)
        parts = [by_role(unit_lists(p, units), first - b, last - b) for p, b in zip(cut, before)]
        return n, [pa.array(["".join(p[r][0].as_py() for p in parts)]) for r in range(3)]
    lists = unit_lists(texts, units)
    n = pc.list_value_length(lists).to_numpy().astype(np.int64)
    return n, by_role(lists, *cuts_of(n, h))


def _transform(units: str, changed: int, suffix_first: int, limit: int):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text")
        h = [batch.column(f"h{k}").to_numpy() for k in range(1, 5)]
        n, (prefix, middle, suffix) = split_texts(texts, h, units, limit)
        plain = pa.array((n == 0) | (h[2] % 100 >= changed))
        for marker in (PREFIX, SUFFIX, MIDDLE):
            plain = pc.or_(plain, pc.match_substring(texts, marker))
        spm = pa.array(h[3] % 100 < suffix_first)
        join = pc.binary_join_element_wise
        output = pc.if_else(spm, join(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, ""), join(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, ""))
        none = pa.scalar(None, pa.int64())
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "n": n, "form": pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm")),
            "prefix_chars": pc.if_else(plain, none, pc.cast(pc.utf8_length(prefix), pa.int64())),
            "middle_chars": pc.if_else(plain, none, pc.cast(pc.utf8_length(middle), pa.int64())), "output": pc.if_else(plain, texts, output)})

    return per_slice(work, limit)


def fill_middle(docs: DataFrame, units: str = "characters", changed: int = CHANGED, suffix_first: int = SUFFIX_FIRST, limit: int = SLICE_BYTES) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars and output of every document."""
    if units not in ("characters", "words", "lines"):
        raise ValueError(f"no such units: {units}")
    rows = text_rows(docs, *[h.alias(f"h{k}") for k, h in enumerate(hashes(F.col("doc_id").cast("long")), 1)])
    return rows.mapInArrow(_transform(units, changed, suffix_first, limit), SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of this form was made of; no marker can stand in the parts."""
    part = F.split(output, "<[PSM]>", -1)
    prefix = F.when(form == "psm", F.get(part, 1)).otherwise(F.get(part, 2))
    suffix = F.when(form == "psm", F.get(part, 2)).otherwise(F.get(part, 1))
    return F.when(form == "plain", output).otherwise(F.concat(prefix, F.get(part, 3), suffix))


def op11_fill_middle(spark: SparkSession, sf: str) -> DataFrame:
    made = fill_middle(spark.read.parquet(f"{sf}/documents.parquet"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


OP11_SQL = """
WITH h AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
g AS (SELECT doc_id, t, length(t) AS n, ('0x' || substr(x, 1, 8))::BIGINT AS h1, ('0x' || substr(x, 9, 8))::BIGINT AS h2,
  ('0x' || substr(x, 17, 8))::BIGINT AS h3, ('0x' || substr(x, 25, 8))::BIGINT AS h4 FROM h),
c AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM g),
p AS (SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1, n - b) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid
    ELSE '<P>' || pre || '<S>' || suf || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p
"""
