"""The same answers in DuckDB SQL, computed from the tables, without a parser."""

from __future__ import annotations

MAIL = """
mail AS (
  SELECT doc_id,
         '<' || doc_id || '@example.com>' AS "ID",
         TIMESTAMP '2000-01-01' + to_seconds(doc_id // 10 * 977 % 20000 * 3600 + doc_id % 10 * 5) AS "Date",
         source || '@example.com' AS "From",
         list_transform(range(0, 1 + doc_id % 5), lambda i: 'r' || i || '.' || doc_id || '@example.com')
           AS "Recipients",
         lang || ' ' || doc_id AS "Subject",
         text AS "Body"
  FROM documents
)
"""

CONVERSATION = """
conversation AS (
  SELECT '<' || conv_id || '.' || turn || '@example.com>' AS "ID",
         TIMESTAMP '2001-01-01' + to_seconds(conv_id * 3600 + turn * 60) AS "Date",
         role || '@example.com' AS "From",
         ['c' || conv_id || '@example.com'] AS "Recipients",
         CAST(NULL AS VARCHAR) AS "Subject",
         text AS "Body"
  FROM conversations
)
"""

# What the parser should make of the raw mails (see corpus.py for the cases).
PARSED = """
named AS (
  SELECT *, 1 + doc_id % 5 AS n,
         doc_id % 7 = 1 AS has_cc, doc_id % 8 = 3 AS has_quote, doc_id % 6 <> 5 AS has_to,
         CASE doc_id % 6
           WHEN 1 THEN list_transform(range(0, 1 + doc_id % 5), lambda i: 'Name ' || i)
           WHEN 2 THEN list_transform(range(0, 1 + doc_id % 5),
                         lambda i: 'Last' || i || ', First' || i || ' </O=X/CN=' || i || '>')
           WHEN 3 THEN list_transform(range(0, 1 + doc_id % 5),
                         lambda i: CASE WHEN i = doc_id % 5 THEN '"Doe, Jane" <jane>'
                                        ELSE '"Name ' || i || '" <n' || i || '>' END)
           WHEN 4 THEN list_transform(range(0, 2 + doc_id % 5), lambda i: 'Name ' || i)
           WHEN 5 THEN ['Nobody']
           ELSE [] END AS names
  FROM mail
),
matched AS (
  SELECT *,
    CASE
      WHEN NOT has_to AND NOT has_quote THEN []
      WHEN NOT has_to THEN ['someone@example.com; Nobody']
      WHEN doc_id % 6 = 0 THEN "Recipients"
      WHEN n = 1 THEN ["Recipients"[1] || '; ' || array_to_string(names, ', ')]
      WHEN doc_id % 6 = 1 THEN list_transform("Recipients", lambda a, i: a || '; ' || names[i])
      WHEN doc_id % 6 = 2
        THEN list_transform("Recipients", lambda a, i: a || '; ' || replace(names[i], ', ', ' '))
      WHEN doc_id % 6 = 3
        THEN list_transform("Recipients", lambda a, i: a || '; ' || CASE WHEN i > 1 THEN ' ' ELSE '' END || names[i])
      ELSE "Recipients" END AS to_list,
    ['c0.' || doc_id || '@example.com', 'c1.' || doc_id || '@example.com'] AS copied,
    CASE
      WHEN has_cc THEN [copied[1] || '; C Zero', copied[2] || '; C One']
      WHEN has_quote THEN ['quoted.' || doc_id || '@example.com']
      ELSE [] END AS cc_list,
    CASE WHEN has_cc THEN copied ELSE [] END AS bcc_list,
    list_concat(list_concat(to_list, cc_list), bcc_list) AS all_recipients,
    list_filter([
        CASE WHEN doc_id % 9 = 4 THEN ' continued' END,
        '',
        replace("Body", chr(13) || chr(10), chr(10)),
        CASE WHEN has_quote THEN '-----Original Message-----' END,
        CASE WHEN has_quote THEN 'From: other@example.com' END,
        CASE WHEN has_quote AND has_to THEN 'To: someone@example.com' END,
        CASE WHEN has_quote THEN 'Subject: re plan' END,
        CASE WHEN has_quote AND has_cc THEN 'Cc: quoted.' || doc_id || '@example.com' END,
        CASE WHEN has_quote THEN 'X-From: kept To: none' END,
        CASE WHEN has_quote THEN 'end' END
      ], lambda l: l IS NOT NULL) AS body_lines,
    array_to_string(body_lines, chr(10)) AS lines_body,
    replace(lines_body, chr(10), '') AS joined_body
  FROM named
)
"""

TOKENS = """list_filter(string_split("Body", ' '), lambda w: w <> '')"""
FIELDS = (
    """"ID", "From", "Subject", {body} AS "Body", strftime("Date", '%Y-%m-%d %H:%M:%S') AS "Date", """
    """array_to_string({recipients}, '|') AS "Recipients\""""
)
READABLE = FIELDS.format(body='"Body"', recipients='"Recipients"')
INTERVAL = """"Date" > TIMESTAMP '2000-03-01' AND "Date" < TIMESTAMP '2001-09-15'"""
TIMES = """"Date" > TIMESTAMP '2000-03-01 07:30:00' AND "Date" < TIMESTAMP '2001-09-14 18:45:10'"""
AVERAGES = f"""avg(len({TOKENS})) AS "avgLength", avg(len("Recipients")) AS "avgNoOfRecipients\""""
TOP_BOTH = """
  SELECT measure, rank, sender, total FROM (
    SELECT *, row_number() OVER (PARTITION BY measure ORDER BY total DESC, sender) AS rank FROM (
      SELECT 'mails' AS measure, "From" AS sender, count(*) AS total FROM {mails} GROUP BY ALL
      UNION ALL
      SELECT 'words', "From", CAST(sum(len({tokens})) AS BIGINT) FROM {mails} GROUP BY ALL))
  WHERE rank <= 5
"""
PARSED_TOKENS = "list_filter(string_split(joined_body, ' '), lambda w: w <> '')"


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def _windows(mails: str, body: str, starts: str, closed: str = "TRUE") -> str:
    """Five most frequent words of every window of one minute."""
    return f"""
  SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS window_start,
         strftime(start + INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end, rank, word, count
  FROM (
    SELECT *, row_number() OVER (PARTITION BY start ORDER BY count DESC, word) AS rank FROM (
      SELECT start, word, count(*) AS count FROM (
        SELECT unnest({starts}) AS start, "Date", words FROM (
          SELECT "Date", list_filter(string_split({body}, ' '), lambda w: w <> '') AS words FROM {mails})
      ), unnest(words) AS u(word)
      WHERE {closed}
      GROUP BY start, word))
  WHERE rank <= 5
"""


TUMBLING = """[date_trunc('minute', "Date")]"""
SLIDING = """[time_bucket(INTERVAL 30 SECOND, "Date"), time_bucket(INTERVAL 30 SECOND, "Date") - INTERVAL 30 SECOND]"""
CLOSED = """start + INTERVAL 1 MINUTE <= (SELECT max("Date") FROM mail) - INTERVAL 1 MINUTE"""

_BY_SENDER = f'{_with(MAIL)} SELECT "From" AS sender, {AVERAGES} FROM mail WHERE {INTERVAL} GROUP BY "From"'
_MAILS = f"{_with(MAIL)} SELECT {READABLE} FROM mail"
_PARSED = _with(MAIL, PARSED)
_PARSED_FIELDS = FIELDS.format(body="joined_body", recipients="all_recipients")
_PARSED_MAILS = f"{_PARSED} SELECT {_PARSED_FIELDS} FROM matched"
_STREAM_TOP = _PARSED + TOP_BOTH.format(mails="matched", tokens=PARSED_TOKENS)
_STREAM_WORDS = _PARSED + _windows("matched", "joined_body", TUMBLING, CLOSED)

_FOLD = "', ' || chr(10) || chr(9)"
_CLEAN_FOLD = "',  ' || chr(9)"


def _folded(parts: str, separator: str) -> str:
    """A header list; mails with ``% 4 = 2`` have it over several lines."""
    plain = f"array_to_string({parts}, ', ')"
    return f"CASE WHEN doc_id % 4 = 2 THEN array_to_string({parts}, {separator}) ELSE {plain} END"


_RAW_LINES = f"""
  list_filter([
    'Message-ID: ' || "ID",
    'Date: ' || strftime("Date" - to_hours(CASE WHEN doc_id % 3 = 0 THEN 8 ELSE 7 END), '%a, %-d %b %Y %H:%M:%S')
             || CASE WHEN doc_id % 3 = 0 THEN ' -0800 (PST)' WHEN doc_id % 11 = 6 THEN ' -0700 (Local)'
                     ELSE ' -0700 (PDT)' END,
    'From: ' || "From",
    CASE WHEN has_to THEN 'To: ' || {_folded('"Recipients"', _FOLD)} END,
    'Subject: ' || "Subject",
    CASE WHEN doc_id % 9 = 4 THEN ' continued' END,
    CASE WHEN has_cc THEN 'Cc: ' || array_to_string(copied, ', ') END,
    'Mime-Version: 1.0', 'Content-Type: text/plain; charset=us-ascii', 'Content-Transfer-Encoding: 7bit',
    CASE WHEN has_cc THEN 'Bcc: ' || array_to_string(copied, ', ') END,
    'X-From: ' || "From",
    'X-To: ' || CASE WHEN doc_id % 6 = 2 THEN {_folded('names', _FOLD)} ELSE array_to_string(names, ', ') END,
    'X-cc: ' || CASE WHEN has_cc THEN 'C Zero, C One' ELSE '' END,
    'X-bcc: ', 'X-Folder: \\Notes\\All', 'X-Origin: X', 'X-FileName: x.nsf', '', "Body",
    CASE WHEN has_quote THEN array_to_string([
      '-----Original Message-----', 'From: other@example.com', 'X-Origin: quoted', 'To: someone@example.com',
      'Subject:  re ' || chr(9) || 'plan', 'Cc: quoted.' || doc_id || '@example.com',
      chr(9) || 'X-From: kept To: none', 'end'], chr(10)) END
  ], lambda l: l IS NOT NULL)
"""
# Damaged mails; one without a sender takes it from the mail it quotes.
_CHECKED = f"""{_PARSED},
  marked AS (
    SELECT *,
           CASE WHEN doc_id % 19 = 7 THEN 'no_id' END AS e1,
           CASE WHEN doc_id % 13 = 5 THEN 'bad_date' END AS e2,
           CASE WHEN doc_id % 17 = 3 AND NOT has_quote THEN 'no_from' END AS e3,
           CASE WHEN len(all_recipients) = 0 THEN 'no_recipients' END AS e4
    FROM matched),
  checked AS (
    SELECT doc_id,
           CASE WHEN doc_id % 17 <> 3 THEN "From" WHEN has_quote THEN 'other@example.com'
                ELSE 'nobody' END AS sender,
           CASE WHEN e1 IS NULL AND e2 IS NULL AND e3 IS NULL THEN ''
                ELSE concat_ws(',', e1, e2, e3, e4) END AS errors
    FROM marked)
"""

ORACLES: dict[str, str] = {
    "avg_mail_stats_by_sender": _BY_SENDER,
    "avg_mail_stats": f"{_with(MAIL)} SELECT {AVERAGES} FROM mail WHERE {INTERVAL}",
    "avg_stored_mail_by_sender": _BY_SENDER,
    "avg_by_sender_where_stored": _BY_SENDER,
    "avg_rollup": f"{_with(MAIL)} SELECT {AVERAGES} FROM mail WHERE {TIMES}",
    "avg_rollup_by_sender": f'{_with(MAIL)} SELECT "From" AS sender, {AVERAGES} FROM mail WHERE {TIMES} GROUP BY "From"',
    "avg_raw_mail_by_sender": f"""{_PARSED}
        SELECT "From" AS sender, avg(len({PARSED_TOKENS})) AS "avgLength",
               avg(len(all_recipients)) AS "avgNoOfRecipients"
        FROM matched WHERE {INTERVAL} GROUP BY "From" """,
    "avg_all_mail_by_sender": f"""{_with(MAIL, CONVERSATION)}
        SELECT "From" AS sender, {AVERAGES}
        FROM (SELECT "From", "Recipients", "Body" FROM mail
              UNION ALL SELECT "From", "Recipients", "Body" FROM conversation)
        GROUP BY "From" """,
    "tokenize": f"""{_with(MAIL)} SELECT "ID", array_to_string({TOKENS}, '|') AS words FROM mail""",
    "tokenize_lines": f"""{_with(MAIL)}
        SELECT "ID", array_to_string(list_filter(
            string_split_regex("Body", '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> ''), '|') AS words
        FROM mail""",
    "word_count": f'{_with(MAIL)} SELECT "ID", len({TOKENS}) AS word_count FROM mail',
    "recipient_count": f'{_with(MAIL)} SELECT "ID", len("Recipients") AS recipient_count FROM mail',
    "mail_features": f"""{_with(MAIL)}
        SELECT "ID", "From", array_to_string({TOKENS}, '|') AS "Words", len({TOKENS}) AS "WordCount",
               len("Recipients") AS "RecipientsCount"
        FROM mail""",
    "project_mail": f"""{_with(MAIL)}
        SELECT "ID", strftime("Date", '%Y-%m-%d %H:%M:%S') AS "Date", "From",
               array_to_string("Recipients", '|') AS "Recipients", "Subject"
        FROM mail""",
    "interval_filter": f"{_MAILS} WHERE {INTERVAL}",
    "interval_filter_stored": f"{_MAILS} WHERE {INTERVAL}",
    "interval_filter_closed": f"""{_MAILS}
        WHERE "Date" BETWEEN TIMESTAMP '2000-01-01 00:00:05' AND TIMESTAMP '2001-06-01'""",
    "conform_schema": f"{_with(CONVERSATION)} SELECT {READABLE} FROM conversation",
    "append_mail": f"""{_with(MAIL, CONVERSATION)}
        SELECT {READABLE} FROM mail UNION ALL SELECT {READABLE} FROM conversation
        UNION ALL SELECT {READABLE} FROM mail""",
    "order_by_date": f"""{_with(MAIL)}
        SELECT strftime("Date", '%Y-%m-%d %H:%M:%S') AS "Date", "ID", "From", "Subject"
        FROM mail ORDER BY mail."Date", "ID" """,
    "sql_over_view": f"""{_with(MAIL)}
        SELECT "From" AS sender, min(len({TOKENS})) AS shortest, max(len({TOKENS})) AS longest,
               count(*) AS mails
        FROM mail WHERE len("Recipients") > 1 GROUP BY "From" """,
    "sender_totals": f"""{_with(MAIL)}
        SELECT "From" AS sender, count(*) AS mails, CAST(sum(len({TOKENS})) AS BIGINT) AS words
        FROM mail GROUP BY "From" """,
    "top_senders_count": f"""{_with(MAIL)}
        SELECT "From" AS sender, count(*) AS mails FROM mail GROUP BY "From"
        ORDER BY mails DESC, sender LIMIT 5""",
    "top_senders_words": f"""{_with(MAIL)}
        SELECT "From" AS sender, CAST(sum(len({TOKENS})) AS BIGINT) AS words FROM mail GROUP BY "From"
        ORDER BY words DESC, sender LIMIT 5""",
    "top_senders_both": _with(MAIL) + TOP_BOTH.format(mails="mail", tokens=TOKENS),
    "word_frequency": f"""{_with(MAIL)}
        SELECT word, count(*) AS count FROM (SELECT unnest({TOKENS}) AS word FROM mail) GROUP BY word""",
    "top_words_window": _with(MAIL) + _windows("mail", '"Body"', TUMBLING),
    "top_words_sliding_window": _with(MAIL) + _windows("mail", '"Body"', SLIDING),
    "mail_parse": _PARSED_MAILS,
    "mail_parse_lines": f"""{_PARSED}
        SELECT {FIELDS.format(body='lines_body', recipients='all_recipients')} FROM matched""",
    "mail_parse_header_only": f"""{_PARSED}
        SELECT "ID", "From", "Subject",
               replace(array_to_string(list_filter([
                 CASE WHEN doc_id % 9 = 4 THEN ' continued' END, "Body",
                 CASE WHEN has_quote THEN '-----Original Message-----From: other@example.com'
                   || 'To: someone@example.comSubject: re planCc: quoted.' || doc_id || '@example.comX-From: kept To: noneend' END
               ], lambda l: l IS NOT NULL), ''), chr(10), '') AS "Body",
               strftime("Date", '%Y-%m-%d %H:%M:%S') AS "Date",
               array_to_string(list_concat(list_concat(
                 CASE WHEN has_to THEN to_list ELSE [] END, CASE WHEN has_cc THEN cc_list ELSE [] END),
                 bcc_list), '|') AS "Recipients"
        FROM matched""",
    "mail_body": f'{_PARSED} SELECT "ID", joined_body AS "Body" FROM matched',
    "mail_date": f"""{_with(MAIL)}
        SELECT "ID", strftime("Date", '%Y-%m-%d %H:%M:%S') AS "Date" FROM mail""",
    "mail_date_by_name": f"""{_with(MAIL)}
        SELECT "ID", CASE WHEN doc_id % 3 = 0 OR (doc_id % 7 <> 2 AND doc_id % 11 <> 6) THEN strftime("Date", '%Y-%m-%d %H:%M:%S') END AS "Date"
        FROM mail""",
    "header_unfold": f"""{_PARSED}
        SELECT doc_id,
               CASE WHEN has_to THEN 'To: ' || {_folded('"Recipients"', _CLEAN_FOLD)} ELSE '' END AS to_line,
               'X-To: ' || CASE WHEN doc_id % 6 = 2 THEN {_folded('names', _CLEAN_FOLD)} ELSE array_to_string(names, ', ') END
                 AS x_to_line
        FROM matched""",
    "header_normalise": f"""{_PARSED}
        SELECT doc_id, unnest(list_filter([
            CASE WHEN has_to THEN 'To: ' || array_to_string("Recipients", ', ') END,
            'Subject: ' || "Subject",
            'X-To: ' || array_to_string(names, ', '),
            'X-cc: ' || CASE WHEN has_cc THEN 'C Zero, C One' ELSE '' END,
            CASE WHEN has_quote THEN 'To: someone@example.com' END,
            CASE WHEN has_quote THEN 'Subject: re plan' END
          ], lambda l: l IS NOT NULL)) AS line
        FROM matched""",
    "recipient_map": f"""{_PARSED}
        SELECT doc_id, array_to_string(to_list, '|') AS to_recipients,
               array_to_string(cc_list, '|') AS cc_recipients
        FROM matched""",
    "recipient_concat": f"""{_PARSED}
        SELECT doc_id, array_to_string(all_recipients, '|') AS recipients,
               len(all_recipients) AS recipient_count
        FROM matched""",
    "mail_quarantine": f"{_CHECKED} SELECT doc_id, errors FROM checked",
    "mail_split": f"""{_CHECKED}
        SELECT sender, CAST(sum(CASE WHEN errors = '' THEN 1 ELSE 0 END) AS BIGINT) AS good,
               CAST(sum(CASE WHEN errors = '' THEN 0 ELSE 1 END) AS BIGINT) AS bad
        FROM checked GROUP BY sender""",
    "scan_mail_files": _PARSED_MAILS,
    "scan_listed_files": _PARSED_MAILS,
    "scan_whole_files": f"""{_PARSED}
        SELECT array_to_string({_RAW_LINES}, chr(10)) AS value FROM matched""",
    "load_parquet_multi": _MAILS,
    "parquet_roundtrip": f"""{_with(MAIL, CONVERSATION)}
        SELECT {READABLE} FROM mail UNION ALL SELECT {READABLE} FROM conversation""",
    "json_document": _BY_SENDER,
    "json_document_many_files": f"""{_with(MAIL)}
        SELECT "ID", "From", len({TOKENS}) AS "WordCount", len("Recipients") AS "RecipientsCount" FROM mail""",
    "json_lines": _BY_SENDER,
    "stream_lines": """
        SELECT unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) AS value FROM documents""",
    "stream_mail": _PARSED_MAILS,
    "stream_listed_mail": _PARSED_MAILS,
    "stream_top_senders": _STREAM_TOP,
    "stream_top_senders_merged": _STREAM_TOP,
    "stream_words_with_late": f"""{_PARSED}
        SELECT strftime(date_trunc('minute', "Date"), '%Y-%m-%d %H:%M:%S') AS window_start, word, count(*) AS count
        FROM (SELECT "Date", unnest({PARSED_TOKENS}) AS word FROM matched)
        GROUP BY window_start, word""",
    "stream_top_senders_count": f"SELECT * FROM ({_STREAM_TOP}) WHERE measure = 'mails'",
    "stream_top_senders_words": f"SELECT * FROM ({_STREAM_TOP}) WHERE measure = 'words'",
    "stream_top_words_window": _STREAM_WORDS,
    "stream_parquet_append": f"""
        SELECT measure AS output, sender AS entry, rank, total AS value FROM ({_STREAM_TOP})
        UNION ALL
        SELECT window_start, word, rank, count FROM ({_STREAM_WORDS})""",
}
ORACLES["stream_lines_update"] = ORACLES["stream_lines"]
ORACLES["sender_totals_rollup"] = ORACLES["sender_totals"]
