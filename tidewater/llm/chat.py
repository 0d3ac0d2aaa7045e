"""Chat formatting by columnar byte assembly."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import table

# Control strings of the template and of common chat formats (fixed values).
OPENERS = re.compile(rb"([<|\[])(\\*)(?=\||>|s>|/s>|INST\]|/INST\])")
ESCAPED = re.compile(rb"([<|\[])\\(\\*)(?=\||>|s>|/s>|INST\]|/INST\])")
CONTROL = re.compile(rb"[<|\[]\\*(?=(\||>|s>|/s>|INST\]|/INST\]))")
END = b"<|end|>\n"
CHUNK = 1 << 20             # bytes scattered at a time
ROWS, BYTES = 500, 1 << 26  # a batch of formatted turns ends at either


def escape(raw):
    """One backslash after the first byte of every control string; strings that
    already hold backslashes there get one more, so unescape is exact."""
    return OPENERS.sub(rb"\1\\\2", raw)


def unescape(raw):
    return ESCAPED.sub(rb"\1\2", raw)


def scatter(out, source, at, lens, to):
    """Copy the segments source[at:at + lens] to out[to:to + lens]. Scatter indices are
    made for CHUNK bytes at a time; a segment of more is copied as it is."""
    for k in np.flatnonzero(lens > CHUNK):
        out[to[k]:to[k] + lens[k]] = source[at[k]:at[k] + lens[k]]
    short = (lens > 0) & (lens <= CHUNK)
    at, lens, to = at[short], lens[short], to[short]
    ends = np.cumsum(lens)
    i = 0
    while i < len(lens):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] - lens[i] + CHUNK, "right")))
        begin = ends[i:j] - lens[i:j] - (ends[i] - lens[i])
        step = np.arange(int(lens[i:j].sum()))
        out[step + np.repeat(to[i:j] - begin, lens[i:j])] = source[step + np.repeat(at[i:j] - begin, lens[i:j])]
        i = j


def column(values):
    """Bytes and 64-bit offsets of an Arrow string or binary column without nulls."""
    values = values.cast(pa.large_binary())
    _, offs, raw = values.buffers()
    offs = np.frombuffer(offs, np.int64)[values.offset:values.offset + len(values) + 1]
    return np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8), offs


def assemble(roles, texts):
    """(buffer, offsets): the formatted turns in one preallocated Arrow buffer.
    Three segments a turn (header, content, end); their lengths and cumulative offsets
    say where headers, the runs of content between control strings, the backslashes put
    into those, and ends go. offsets has three entries a turn and the total."""
    n = len(roles)
    coded = roles.dictionary_encode()
    heads = [b"<|" + escape(r.encode()) + b"|>\n" for r in coded.dictionary.to_pylist()]
    role = coded.indices.to_numpy(zero_copy_only=False)
    head_lens = np.array([len(h) for h in heads], np.int64)
    head_at = np.cumsum(head_lens) - head_lens
    raw, offs = column(texts)
    start, stop = offs[:-1], offs[1:]
    first, last = int(offs[0]), int(offs[-1])
    # control strings of all texts at once; one that reaches beyond its own text is none
    found = np.array([(m.start(), m.end(1)) for m in CONTROL.finditer(raw, first, last)], np.int64).reshape(-1, 2)
    row = np.searchsorted(start, found[:, 0], "right") - 1
    inside = found[:, 1] <= stop[row]
    found, row = found[inside], row[inside]
    put = np.bincount(row, minlength=n)
    lens = np.stack([head_lens[role], stop - start + put, np.full(n, len(END))], 1).ravel()
    out_offs = np.concatenate([[0], np.cumsum(lens)])
    buf = pa.allocate_buffer(int(out_offs[-1]))
    out = np.frombuffer(buf, np.uint8)
    scatter(out, np.frombuffer(b"".join(heads), np.uint8), head_at[role], head_lens[role], out_offs[0:-1:3])
    # runs of content: the text's begin and the place after each control string's first byte
    rank = np.arange(len(row)) - (np.cumsum(put) - put)[row] + 1
    at, rows, ranks = np.append(start, found[:, 0] + 1), np.append(np.arange(n), row), np.append(np.zeros(n, np.int64), rank)
    order = np.lexsort((ranks, rows))
    at, rows, ranks = at[order], rows[order], ranks[order]
    to = out_offs[1::3][rows] + at - start[rows] + ranks
    scatter(out, raw, at, np.append(at[1:], last) - at, to)
    out[to[ranks > 0] - 1] = ord("\\")
    scatter(out, np.frombuffer(END, np.uint8), np.zeros(n, np.int64), lens[2::3], out_offs[2::3])
    return buf, out_offs


SEGMENTS = "conv_id long, formatted binary, loss_start long, loss_end long"


def format_turns(rows):
    """One formatted segment per turn, in conversation order within a partition.

    A conversation's text is its segments one after the other; loss_start and
    loss_end bound the bytes under the loss mask in a segment (assistant turns).
    Rows are ordered by turn, role, text; null role or text is empty, null
    turns come first, repeated rows stay, null conv_id is a conversation; an empty
    table gives no rows. Other columns are not read. Batches end at ROWS turns or
    BYTES of text, so buffers and indices stay bounded; one formatted turn must stay
    under 2 GB, as any value in Spark.
    """
    sorted_rows = (rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                               F.coalesce("text", F.lit("")).alias("text"))
                   .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))

    def run(batches):
        for whole in batches:
            ends = np.cumsum(np.diff(column(whole.column("text"))[1]))
            at = 0
            while at < whole.num_rows:
                done = ends[at - 1] if at else 0
                b = whole.slice(at, min(ROWS, max(1, int(np.searchsorted(ends, done + BYTES, "right")) - at)))
                at += b.num_rows
                buf, offs = assemble(b.column("role"), b.column("text"))
                on = np.array([r == "assistant" for r in b.column("role").to_pylist()])
                seg = pa.Array.from_buffers(pa.large_binary(), b.num_rows, [None, pa.py_buffer(offs[::3].copy()), buf])
                yield pa.RecordBatch.from_arrays(
                    [b.column("conv_id"), seg.cast(pa.binary()), pa.array(np.where(on, offs[1::3] - offs[0:-1:3], 0)),
                     pa.array(np.where(on, offs[2::3] - offs[0:-1:3], 0))],
                    names=["conv_id", "formatted", "loss_start", "loss_end"])

    return sorted_rows.mapInArrow(run, SEGMENTS)


def digest(segments):
    """One row per conversation, read back from the formatted bytes in streaming
    order: a conversation of any length needs one turn in memory."""
    schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long")
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches):
        state, out = None, []

        def done():
            cid, n, turns, lc, loss, fc = state
            out.append((cid, n, turns.hexdigest(), lc, loss.hexdigest(), fc))

        for b in batches:
            for row in b.to_pylist():
                if state is None or state[0] != row["conv_id"]:
                    if state:
                        done()
                    state = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                raw = row["formatted"]
                cut = raw.index(b"|>\n", 2)
                role, body = unescape(raw[2:cut]), unescape(raw[cut + 3:raw.index(b"<|end|>", cut + 3)])
                state[1] += 1
                state[2].update(role + b"\n" + body + b"\n")
                masked = unescape(raw[row["loss_start"]:row["loss_end"]])
                state[3] += len(masked.decode())
                state[4].update(masked)
                state[5] += len(raw.decode())
            if len(out) >= 2000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                out = []
        if state:
            done()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return segments.mapInArrow(run, schema)


def op2(spark, sf_dir):
    own = spark.createDataFrame([(-7, 0, "user", "</s>[INST] ok [/INST]"),
                                 (-7, 1, "assistant", "</s>[INST] ok [/INST]")],
                                "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digest(format_turns(rows.unionByName(own)))
