"""Mail made from the driver's tables.

``documents`` gives a mail table and, written out with headers, raw mails for
the parser; ``conversations`` gives a second mail table.  Which of the awkward
forms a raw mail takes follows from its number:

* ``% 6``: display names absent, one each, "Last, First", quoted with a comma,
  too many, or no To header at all;
* ``% 4 = 2``: address headers run over several lines;
* ``% 7 = 1``: Cc, and a Bcc that repeats it;
* ``% 9 = 4``: the subject runs over two lines;
* ``% 11 = 6``: the zone's name in the date is none;
* ``% 8 = 3``: the body quotes another mail with headers, a noise line, and an indented one that is none.

With ``damaged=True`` also ``% 13 = 5`` an unreadable date or an offset out of range, ``% 17 = 3`` no
sender and ``% 19 = 7`` no id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailgauge.schema import MAIL_COLUMNS

EPOCH_2000 = 946684800  # 2000-01-01 00:00:00 UTC
EPOCH_2001 = 978307200  # 2001-01-01 00:00:00 UTC


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


# Dates lie within so many hours.
HOURS = 20_000

# The mail columns of a row of documents: ten mails a minute, over 833 days.
MAIL_OF_DOCUMENT = [
    "concat('<', doc_id, '@example.com>') AS ID",
    f"timestamp_seconds(doc_id div 10 * 977 % {HOURS} * 3600 + doc_id % 10 * 5 + {EPOCH_2000}) AS Date",
    "concat(source, '@example.com') AS `From`",
    "transform(sequence(0, CAST(doc_id % 5 AS INT)), i -> concat('r', i, '.', doc_id, '@example.com'))"
    " AS Recipients",
    "concat_ws(' ', lang, doc_id) AS Subject",
    "text AS Body",
]


def document_mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).selectExpr(*MAIL_OF_DOCUMENT)


def conversation_mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A turn as a mail from its role; columns in another order, and no subject."""
    return table(spark, sf_dir, "conversations").selectExpr(
        "text AS body",
        "concat(role, '@example.com') AS `from`",
        f"timestamp_seconds(conv_id * 3600 + turn * 60 + {EPOCH_2001}) AS date",
        "concat('<', conv_id, '.', turn, '@example.com>') AS id",
        "array(concat('c', conv_id, '@example.com')) AS recipients",
        "turn AS unused",
    )


def _numbered(name: str, upto: str, separator: str = ", ") -> str:
    return f"array_join(transform(sequence(0, CAST({upto} AS INT)), i -> {name}), '{separator}')"


# A folded header goes on after a line break and a tab.
FOLDED = r", \n\t"
LAST_FIRST = "concat('Last', i, ', First', i, ' </O=X/CN=', i, '>')"
QUOTED = """if(i = doc_id % 5, '"Doe, Jane" <jane>', concat('"Name ', i, '" <n', i, '>'))"""

X_TO = f"""
  CASE doc_id % 6
    WHEN 1 THEN {_numbered("concat('Name ', i)", "doc_id % 5")}
    WHEN 2 THEN if(doc_id % 4 = 2, {_numbered(LAST_FIRST, "doc_id % 5", FOLDED)},
                   {_numbered(LAST_FIRST, "doc_id % 5")})
    WHEN 3 THEN {_numbered(QUOTED, "doc_id % 5")}
    WHEN 4 THEN {_numbered("concat('Name ', i)", "doc_id % 5 + 1")}
    WHEN 5 THEN 'Nobody'
    ELSE '' END
"""

COPIED = "concat('c0.', doc_id, '@example.com, c1.', doc_id, '@example.com')"


def raw_mails(rows: DataFrame, damaged: bool = False) -> DataFrame:
    """doc_id and ``value``, the mail as it would stand in a file.  Batch or stream."""
    date = """concat(
      date_format(Date - make_dt_interval(0, if(doc_id % 3 = 0, 8, 7)), 'E, d MMM yyyy HH:mm:ss'),
      CASE WHEN doc_id % 3 = 0 THEN ' -0800 (PST)' WHEN doc_id % 11 = 6 THEN ' -0700 (Local)'
           ELSE ' -0700 (PDT)' END)"""
    no_id = no_from = "false"
    if damaged:
        bad = "if(doc_id % 2 = 0, 'yesterday', 'Tue, 4 Jul 2000 10:00:00 -9900 (PDT)')"
        date = f"if(doc_id % 13 = 5, {bad}, {date})"
        no_id, no_from = "doc_id % 19 = 7", "doc_id % 17 = 3"
    # concat_ws leaves out what is null.
    value = rf"""concat_ws('\n',
      if({no_id}, NULL, concat('Message-ID: ', ID)),
      concat('Date: ', {date}),
      if({no_from}, NULL, concat('From: ', `From`)),
      if(doc_id % 6 = 5, NULL, concat('To: ',
         if(doc_id % 4 = 2, array_join(Recipients, '{FOLDED}'), array_join(Recipients, ', ')))),
      concat('Subject: ', Subject),
      if(doc_id % 9 = 4, ' continued', NULL),
      if(doc_id % 7 = 1, concat('Cc: ', {COPIED}), NULL),
      'Mime-Version: 1.0\nContent-Type: text/plain; charset=us-ascii\nContent-Transfer-Encoding: 7bit',
      if(doc_id % 7 = 1, concat('Bcc: ', {COPIED}), NULL),
      concat('X-From: ', `From`),
      concat('X-To: ', {X_TO}),
      concat('X-cc: ', if(doc_id % 7 = 1, 'C Zero, C One', '')),
      'X-bcc: \nX-Folder: \\Notes\\All\nX-Origin: X\nX-FileName: x.nsf\n',
      Body,
      if(doc_id % 8 = 3, concat(
        '-----Original Message-----\nFrom: other@example.com\nX-Origin: quoted\nTo: someone@example.com\n',
        'Subject:  re \tplan\nCc: quoted.', doc_id, '@example.com\n\tX-From: kept To: none\nend'), NULL))"""
    return rows.selectExpr("doc_id", *MAIL_OF_DOCUMENT).selectExpr("doc_id", f"{value} AS value")


def raw_document_mails(spark: SparkSession, sf_dir: str, damaged: bool = False) -> DataFrame:
    return raw_mails(documents(spark, sf_dir), damaged)


def readable(mails: DataFrame, *extra: str) -> DataFrame:
    """Mail columns with date and recipients as text, so that any engine can compare them."""
    return mails.select(
        *[c for c in MAIL_COLUMNS if c not in ("Date", "Recipients")],
        F.date_format("Date", "yyyy-MM-dd HH:mm:ss").alias("Date"),
        F.array_join("Recipients", "|").alias("Recipients"),
        *extra,
    )
