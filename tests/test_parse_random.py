"""The parser against a plain line-by-line model, on random mails."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from mailgauge.functions import headers as H
from mailgauge.operators.parse import mail_fields

LINES = (
    [f"{name}: {value}" for name in H.FIELDS for value in ("a@x", "a@x, b@x, ", 'A, "B, C"', "", "  two  \t blanks")]
    + [f"{name}:" for name in H.FIELDS]
    + [f"{name}: noise" for name in H.NOISE]
    + ["\tX-From: Bo To: Al", "\tContent-Type: see Subject", "X-From:\t\tTo:", " X-Origin: a  Cc: b"]
    + ["", "", "", " continued", "\tcontinued, ", "words in the body", "say To: you", "a:b", ":", " To: indented"]
    + ["X-bcc: ", "X-bcc: last", "Subject:\tno blank", "the Subject  is", "X-bccc: no", "Cc", "to: lower"]
    + ["To: é@x, \U0001f600 b@x", "X-To: \U0001f600", "ünïcode \U0001f600  To:\tline", "\u2028To: no line", "日本: 語"]
)


def name_of(line):
    return line.split(":")[0] if ":" in line else None


def model(raw, body, header_only):
    lines = [line for line in raw.replace("\r\n", "\n").split("\n") if name_of(line) not in H.NOISE]
    whole, running, finished = [], None, False
    for line in lines:
        ends = H.FOLD_ENDS if running == "X-bcc" else [*H.FOLD_ENDS, "To"]
        if running and line and name_of(line) not in ends:
            whole[-1] += " " + line
            continue
        finished = finished or running == "X-bcc"
        running = name_of(line) if name_of(line) in H.FOLDED and not finished else None
        whole.append(line)
    tokens = ("To:", "Cc:", "Bcc:", "X-cc:", "X-bcc:", "Subject")
    whole = [
        line.replace("\t", "").replace("  ", " ") if any(t in line for t in tokens) else line for line in whole
    ]
    fields, rest, in_header = dict.fromkeys(H.FIELDS), [], True
    for line in whole:
        in_header = in_header and line != ""
        name = name_of(line)
        if name in fields and fields[name] is None and (in_header or not header_only):
            fields[name] = line.split(" ", 1)[1] if " " in line else line
        else:
            rest.append(line)
    return {**fields, "Body": ("\n" if body == "lines" else "").join(rest)}


@pytest.mark.parametrize("body, header_only", [("joined", False), ("lines", False), ("joined", True)])
def test_random_mails(spark, body, header_only):
    rng = random.Random(f"{body} {header_only}")
    raws = []
    for _ in range(4000):
        lines = rng.choices(LINES, k=rng.randint(0, 25))
        raws.append(rng.choice(["\n", "\n", "\r\n"]).join(lines))
    frame = spark.createDataFrame(list(enumerate(raws)), "n int, value string")
    rows = mail_fields(frame, keep=["n"], body=body, header_only=header_only).orderBy("n").collect()
    assert len(rows) == len(raws)
    for raw, row in zip(raws, rows):
        got, expected = row.asDict(), model(raw, body, header_only)
        del got["n"]
        if body == "lines":  # line breaks at the end of a mail say nothing
            got["Body"], expected["Body"] = got["Body"].rstrip("\n"), expected["Body"].rstrip("\n")
        assert got == expected, repr(raw)


def test_model_agrees_on_long_mails(spark):
    rng = random.Random(7)
    raw = "\n".join(rng.choices(LINES, k=20_000))
    long_fold = "To: a@x\n" + "\tb@x, \n" * 50_000 + "X-bcc: \n" + "\tc@x\n" * 50_000 + "\nend"
    frame = spark.createDataFrame([(0, raw), (1, long_fold)], "n int, value string")
    rows = mail_fields(frame, keep=["n"]).orderBy("n").select(F.struct(*H.FIELDS, "Body").alias("r")).collect()
    assert rows[0].r.asDict() == model(raw, "joined", False)
    assert rows[1].r.asDict() == model(long_fold, "joined", False)
