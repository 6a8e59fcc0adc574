"""The parser on hand-written mails: every recipient form and every awkward case."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from mailgauge.functions.recipients import map_recipients, split_list, split_unquoted
from mailgauge.operators.averages import averages, mail_lengths
from mailgauge.operators.parse import mail_fields, parse_mail, split_valid, unfold_header
from mailgauge.operators.relational import in_interval

HEAD = """Message-ID: <1@x>
Date: Wed, 8 Nov 2000 06:35:20 -0700 (PDT)
From: a@x.com
To: b@x.com
Subject: hello
Mime-Version: 1.0
Content-Type: text/plain; charset=us-ascii
Content-Transfer-Encoding: 7bit
X-From: A
X-To: Bee
X-cc: 
X-bcc: 
X-Folder: \\x
X-Origin: X
X-FileName: x.nsf
"""


def utc(*parts):
    return dt.datetime(*parts, tzinfo=dt.timezone.utc).astimezone().replace(tzinfo=None)


def parsed(spark, *raws, **options):
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "n int, value string")
    rows = parse_mail(frame, keep=["n"], **options).orderBy("n").collect()
    return rows if len(raws) > 1 else rows[0]


def mapped(spark, addresses, names):
    frame = spark.createDataFrame([(addresses, names)], "a string, n string")
    return frame.select(map_recipients("a", "n")).head()[0]


def test_plain_mail(spark):
    row = parsed(spark, HEAD + "\nfirst line\nsecond  line\n")
    assert row.ID == "<1@x>"
    assert row.Date == utc(2000, 11, 8, 13, 35, 20)
    assert row.From == "a@x.com"
    assert row.Recipients == ["b@x.com; Bee"]
    assert row.Subject == "hello"
    assert row.Body == "first linesecond  line"
    assert row._error == []


def test_body_with_line_breaks(spark):
    row = parsed(spark, HEAD + "\nfirst line\n\nlast", body="lines")
    assert row.Body == "\nfirst line\n\nlast"


def test_unknown_body_form_is_refused(spark):
    with pytest.raises(ValueError):
        parsed(spark, HEAD, body="words")


def test_crlf_is_the_same_as_lf(spark):
    raw = HEAD + "\nfirst line\nsecond line\n"
    lf, crlf = parsed(spark, raw, raw.replace("\n", "\r\n"))
    assert lf[:-2] == crlf[:-2]


def test_noise_lines_are_dropped_from_the_body_too(spark):
    row = parsed(spark, HEAD + "\none\nX-From: someone\nContent-Type: text\nX-Fro: kept\ntwo")
    assert row.Body == "oneX-Fro: kepttwo"


def test_only_line_feeds_end_lines(spark):
    row = parsed(spark, HEAD + "\none X-From: kept\x85To: kept too\rSubject: as well")
    assert row.Body == "one X-From: kept\x85To: kept too\rSubject: as well"


def test_folded_headers(spark):
    raw = HEAD.replace("To: b@x.com\n", "To: b@x.com, c@x.com, \n\td@x.com, \n\te@x.com\n", 1)
    raw = raw.replace("X-To: Bee", "X-To: Bee, Cee, \n\tDee, Eee")
    row = parsed(spark, raw + "\nbody")
    assert row.Recipients == ["b@x.com; Bee", "c@x.com; Cee", "d@x.com; Dee", "e@x.com; Eee"]
    assert row.Body == "body"


def test_folded_last_header_ends_at_the_empty_line(spark):
    # It takes everything up to there, a "To:" line as well.
    raw = HEAD.replace("X-bcc: \n", "X-bcc: Bee, \n\tCee\nTo: not a header\n")
    raw = raw.replace("Subject:", "Bcc: b@x.com, c@x.com\nSubject:", 1)
    row = parsed(spark, raw + "\nbody")
    assert row.Recipients[1:] == ["b@x.com; Bee", "c@x.com; Cee To: not a header"]
    assert row.Body == "body"


def test_nothing_is_unfolded_after_the_last_header(spark):
    row = parsed(spark, HEAD + "\nCc: c@x.com\ncontinued\n")
    assert row.Recipients == ["b@x.com; Bee", "c@x.com"]
    assert row.Body == "continued"


def test_to_right_after_an_address_header_starts_a_header(spark):
    raw = HEAD.replace("To: b@x.com\n", "Cc: c@x.com\nTo: b@x.com\n", 1)
    assert parsed(spark, raw + "\n").Recipients == ["b@x.com; Bee", "c@x.com"]


def test_folded_subject_goes_to_the_body(spark):
    row = parsed(spark, HEAD.replace("hello\n", "hello\n world\n") + "\nbody")
    assert (row.Subject, row.Body) == ("hello", " worldbody")


def test_second_occurrence_goes_to_the_body(spark):
    row = parsed(spark, HEAD + "\nSubject: quoted\nFrom: q@x.com\nend")
    assert (row.Subject, row.From) == ("hello", "a@x.com")
    assert row.Body == "Subject: quotedFrom: q@x.comend"


def test_missing_field_is_taken_from_quoted_mail(spark):
    raw = HEAD + "\nOriginal\nCc: q@x.com, r@x.com\nend"
    default, strict = parsed(spark, raw), parsed(spark, raw, header_only=True)
    assert default.Recipients == ["b@x.com; Bee", "q@x.com", "r@x.com"]
    assert default.Body == "Originalend"
    assert strict.Recipients == ["b@x.com; Bee"]
    assert strict.Body == "OriginalCc: q@x.com, r@x.comend"


def test_repeated_recipients_count_twice(spark):
    raw = HEAD.replace("Subject:", "Cc: c@x.com\nBcc: c@x.com\nSubject:", 1)
    assert parsed(spark, raw + "\n").Recipients == ["b@x.com; Bee", "c@x.com", "c@x.com"]


def test_no_to_ignores_the_names(spark):
    row = parsed(spark, HEAD.replace("To: b@x.com\n", "", 1) + "\nbody")
    assert row.Recipients == []
    assert row._error == ["no_recipients"]


def test_header_without_blank_is_its_own_value(spark):
    row = parsed(spark, HEAD.replace("Subject: hello", "Subject:") + "\nbody")
    assert row.Subject == "Subject:"


def test_blanks_are_cleaned_in_lines_that_name_a_header(spark):
    row = parsed(spark, HEAD + "\nthe  Subject\tis   this\nplain  line\twith tab\nsee To:\there")
    assert row.Body == "the Subjectis  thisplain  line\twith tabsee To:here"


def test_empty_and_header_only_mails(spark):
    nothing, blank, cut, no_last = parsed(spark, "", "\n\n", HEAD[:60], HEAD.split("X-bcc")[0] + "\nbody")
    assert nothing._error == ["no_id", "bad_date", "no_from", "no_recipients"]
    assert (nothing.Body, nothing.Recipients, nothing.Subject) == ("", [], None)
    assert blank._error == nothing._error
    assert cut.ID == "<1@x>" and "no_from" in cut._error
    assert no_last.Body == "body" and no_last.Recipients == ["b@x.com; Bee"]


def test_quarantine(spark):
    raws = [
        HEAD,
        HEAD.replace("Wed, 8 Nov", "Wed, some Nov"),
        HEAD.replace("From: a@x.com\n", "", 1),
        HEAD.replace("To: b@x.com\n", "", 1),
        "",
    ]
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "n int, value string")
    good, bad = split_valid(parse_mail(frame, keep=["n"]))
    assert sorted(r.n for r in good.collect()) == [0, 3]
    assert {r.n: r._error for r in bad.collect()} == {
        1: ["bad_date"],
        2: ["no_from"],
        4: ["no_id", "bad_date", "no_from", "no_recipients"],
    }
    strict, _ = split_valid(parse_mail(frame, keep=["n"]), fatal=["no_recipients"])
    assert sorted(r.n for r in strict.collect()) == [0, 1, 2]


def test_interval_before_the_body_is_put_together(spark):
    dates = ["Mon, 1 Jan 2001", "Tue, 2 Jan 2001", "Wed, 3 Jan 2001", "never"]
    raws = [HEAD.replace("Wed, 8 Nov 2000", d) + "\nbody" for d in dates]
    frame = spark.createDataFrame(list(enumerate(raws)), "n int, value string")
    early = parse_mail(frame, keep=["n"], between=("2001-01-02", "2001-01-04"))
    late = in_interval(parse_mail(frame, keep=["n"]), "2001-01-02", "2001-01-04")
    assert sorted(early.collect()) == sorted(late.collect()) and early.count() == 2
    plan = early._jdf.queryExecution().optimizedPlan().toString()
    body, interval = plan.index("AS Body"), plan.index("Filter")
    assert body < interval  # a plan is printed from the top


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Tue, 4 Mar 2003 18:05:30 +0100 (CET)", utc(2003, 3, 4, 17, 5, 30)),
        ("Tue, 00004 Mar 2003 18:05:30 +0100 (CET)", utc(2003, 3, 4, 17, 5, 30)),
        ("Tue, -1 Mar 2003 018:5:30 +0100 (CET)", utc(2003, 2, 27, 17, 5, 30)),
        ("Tue, 99999999999999999999 Mar 2003 18:05:30 +0100 (CET)", None),
        ("Tue, 2000000000 Mar 2003 18:05:30 +0100 (CET)", None),
        ("Mon, 1 Jan 2001 00:00:00 +0130 (XYZ)", utc(2000, 12, 31, 22, 30)),
        ("Mon, 1 Jan 2001 00:00:00 +2359 (XYZ)", utc(2000, 12, 31, 0, 1)),
        ("Mon, 1 Jan 2001 00:00:00 +2400 (XYZ)", None),
        ("Mon, 1 Jan 2001 00:00:00 -0160 (XYZ)", None),
        ("monday, 01 JANUARY 2001 1:2:3 +0000 (GMT)", utc(2001, 1, 1, 1, 2, 3)),
        ("Wed, 31 Feb 2001 25:00:61 +0000 (GMT)", utc(2001, 3, 4, 1, 1, 1)),
        ("Mon, 31 Dec 1979 16:00:00 -0800 (PST)", utc(1980, 1, 1)),
        ("Tue, 4 Mar 2003 18:05:30 +0100", None),
        ("4 Mar 2003 18:05:30 +0100 (CET)", None),
        ("Tue, 4 Maerz 2003 18:05:30 +0100 (CET)", None),
        ("Date:", None),
        ("", None),
    ],
)
def test_dates(spark, text, expected):
    row = parsed(spark, HEAD.replace("Wed, 8 Nov 2000 06:35:20 -0700 (PDT)", text) + "\n")
    assert row.Date == expected


@pytest.mark.parametrize(
    "zone, expected",
    [
        ("-0500 (PDT)", utc(2001, 6, 1, 19, 30)),
        ("+0200 (gmt)", utc(2001, 6, 1, 12, 30)),
        ("+0000 (EST)", utc(2001, 6, 1, 17, 30)),
        ("-0700 (a, b)", None),
        ("-9900 (PDT)", None),
        ("-0700", None),
    ],
)
def test_zone_name_counts_when_asked(spark, zone, expected):
    text = HEAD.replace("Wed, 8 Nov 2000 06:35:20 -0700 (PDT)", f"Fri, 1 Jun 2001 12:30:00 {zone}") + "\n"
    assert parsed(spark, text, zone="name").Date == expected


def test_date_without_zone_name_when_allowed(spark):
    row = parsed(spark, HEAD.replace(" (PDT)", "") + "\n", zone_required=False)
    assert row.Date == utc(2000, 11, 8, 13, 35, 20)


def test_recipient_forms(spark):
    assert mapped(spark, None, "A") == []
    assert mapped(spark, "", "A, B") == []
    assert mapped(spark, "a@x, b@x", None) == ["a@x", "b@x"]
    assert mapped(spark, "a@x, b@x", "") == ["a@x", "b@x"]
    assert mapped(spark, "a@x", "Doe, Jane, anything") == ["a@x; Doe, Jane, anything"]
    assert mapped(spark, "a@x, b@x", "A, b@x") == ["a@x; A", "b@x; b@x"]
    assert mapped(spark, "a@x, b@x, c@x", "A, B") == ["a@x", "b@x", "c@x"]


def test_last_first_names(spark):
    names = "Berg, Ida </O=Q/CN=i1>, Lund, Olof </O=Q/CN=o2>"
    assert mapped(spark, "ida@x, olof@x", names) == [
        "ida@x; Berg Ida </O=Q/CN=i1>",
        "olof@x; Lund Olof </O=Q/CN=o2>",
    ]


def test_quoted_names(spark):
    plain = '"Nils at home" <n@x>, "Tove at home" <t@x>'
    assert mapped(spark, "n@x, t@x", plain) == ['n@x; "Nils at home" <n@x>', 't@x; "Tove at home" <t@x>']
    comma = '"Greta Holm" <g@x>, "Dahl, Per" <d@x>'
    assert mapped(spark, "g@x, d@x", comma) == ['g@x; "Greta Holm" <g@x>', 'd@x;  "Dahl, Per" <d@x>']


def test_list_splitting_drops_empty_parts_at_the_end_only(spark):
    frame = spark.createDataFrame([(v,) for v in ["a, b, , ", ", a", ", , ", "a,b", "a"]], "v string")
    rows = [r[0] for r in frame.select(F.expr(split_list("v"))).collect()]
    assert rows == [["a", "b"], ["", "a"], [], ["a,b"], ["a"]]
    assert mapped(spark, ", ", "A") == []
    assert mapped(spark, "a@x, b@x, ", "A, B") == ["a@x; A", "b@x; B"]


def test_unbalanced_quotes(spark):
    frame = spark.createDataFrame([(v,) for v in ['a,"b,c', '"a,b",c', '"a","b,c"', "a,,b,,", ",,"]], "v string")
    rows = [r[0] for r in frame.select(F.expr(split_unquoted("v"))).collect()]
    assert rows == [['a,"b', "c"], ['"a,b"', "c"], ['"a"', '"b,c"'], ["a", "", "b"], []]


def test_huge_recipient_list(spark):
    n = 20_000
    addresses = ", ".join(f"p{i}@x.com" for i in range(n))
    names = ", ".join(f'"Last{i}, First" <p{i}>' if i % 2 else f'"P{i}" <p{i}>' for i in range(n))
    raw = HEAD.replace("b@x.com", addresses.replace(", ", ", \n\t"), 1).replace("Bee", names.replace(">, ", ">, \n\t"))
    row = parsed(spark, raw + "\nbody")
    assert len(row.Recipients) == n
    assert row.Recipients[:2] == ['p0@x.com; "P0" <p0>', 'p1@x.com;  "Last1, First" <p1>']
    assert row.Body == "body"


def test_filter_on_parsed_columns_runs_the_parser_once(spark):
    frame = spark.createDataFrame([(HEAD + "\none two\n",)], "value string")
    mails = in_interval(parse_mail(frame), "2000-04-12", "2001-08-19").filter("From LIKE 'a%'")
    plan = averages(mail_lengths(mails))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("X-From):[^") == 1
    row = averages(mail_lengths(mails)).head()
    assert (row.avgLength, row.avgNoOfRecipients) == (2.0, 1.0)


def test_parser_is_one_stage_without_python(spark, tmp_path):
    spark.createDataFrame([(HEAD,)], "value string").write.parquet(str(tmp_path / "t"))
    plan = parse_mail(spark.read.parquet(str(tmp_path / "t")))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_null_mail_is_flagged(spark):
    row = parsed(spark, None)
    assert (row.ID, row.Body, row.Recipients) == (None, None, [])
    assert row._error == ["no_id", "bad_date", "no_from", "no_recipients"]


def test_building_blocks_keep_columns(spark):
    frame = spark.createDataFrame([(7, HEAD + "\nbody")], "n int, value string")
    header = unfold_header(frame, keep=["n"]).head()
    assert header.rest == "\nbody" and header.header.endswith("X-bcc: ") and header.n == 7
    fields = mail_fields(frame, keep=["n"]).head()
    assert fields["Message-ID"] == "<1@x>" and fields["Cc"] is None and fields["X-cc"] == "" and fields.n == 7
