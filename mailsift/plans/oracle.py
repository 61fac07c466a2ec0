"""DuckDB SQL for every query in ``mailsift.plans.queries`` (same column names).

Written independently of the Spark code path: the Spark side composes
operators, this side restates the semantics in plain SQL over the same
driver tables (views ``pages``, ``events``, ``documents`` ...).
"""

from __future__ import annotations

from mailsift.plans import standins as S

# Written out here on purpose: the checks must not take their expectations
# from the code that they check.
MONTHS_LONG = ("january february march april may june july august september october november "
               "december").split()
MONTHS_SHORT = [m[:3] for m in MONTHS_LONG]
ZONE_NAMES = {"UT": 0, "UTC": 0, "GMT": 0, "Z": 0, "EST": -300, "EDT": -240, "CST": -360,
              "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "AST": -240,
              "ADT": -180}
PLAIN_PREFIX, PLAIN_SUFFIX = "<html><body><pre>", "</pre></body></html>"
LIST_HEADING = "# Alert items (saved)"
PROMPT_HEAD = """Below is a numbered list of papers from today's alerts.
Work only with those that bear on: {terms}. Leave the others out.
Write Markdown in two parts and nothing else.

# Digest
One level-three section per paper, headed by its title: what was done and found (at most three \
sentences), one limitation the authors would admit, and the link as given.

# Next steps
Five experiments that these papers make possible, one paragraph each: the question, why it is \
open, what it needs, and what an answer would change.

Papers:"""

WS = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\p{Z}]"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def host(url: str) -> str:
    return f"lower(regexp_extract({url}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#@]+)', 1))"


def decode(x: str) -> str:
    for ent, ch in (("&nbsp;", "chr(160)"), ("&lt;", "'<'"), ("&gt;", "'>'"),
                    ("&quot;", "'\"'"), ("&#39;", "''''"), ("&apos;", "''''"), ("&amp;", "'&'")):
        x = f"replace({x}, '{ent}', {ch})"
    return x


def lst(terms) -> str:
    return "[" + ", ".join(q(t) for t in terms) + "]::VARCHAR[]"


ANCHOR_RE = r"(?is)<a\b[^>]*>.*?</a\s*>"
HAS_HREF = r"(?is)^<a\b[^>]*?\shref\s*="


def title_expr(tag: str) -> str:
    inner = f"regexp_extract({tag}, '(?is)^<a\\b[^>]*>(.*)</a\\s*>$', 1)"
    inner = f"regexp_replace({inner}, '(?s)<!--.*?-->', '', 'g')"
    inner = f"replace({inner}, '&nbsp;', chr(160))"
    notags = f"regexp_replace({inner}, '(?s){WS}*<[^>]*>{WS}*', '', 'g')"
    return strip(decode(notags))


def link_expr(tag: str) -> str:
    open_ = f"regexp_extract({tag}, '(?is)^(<a\\b[^>]*>)', 1)"
    raw = (f"regexp_extract({open_}, "
           "'(?is)^<a\\b[^>]*?\\shref\\s*=\\s*(\"[^\"]*\"|''[^'']*''|[^\\s\"''>]+)', 1)")
    unq = f"regexp_replace({raw}, '^\"(.*)\"$|^''(.*)''$', '\\1\\2')"
    return decode(unq)


def anchors_cte(min_len: int = 4, extra: str = "") -> str:
    """CTE ``anchors(uid, sender, pos, title, link)`` over all pages, X1 + X2."""
    return f"""
page_msgs AS (
  SELECT page_id AS uid, {host('url')} AS sender, html FROM pages),
anchor_lists AS (
  SELECT uid, sender,
         list_filter(regexp_extract_all(html, '{ANCHOR_RE}', 0),
                     lambda t: regexp_matches(t, '{HAS_HREF}')) AS l
  FROM page_msgs {extra}),
anchor_tags AS (
  SELECT uid, sender, unnest(l) AS tag, unnest(generate_series(1, len(l))) AS pos
  FROM anchor_lists),
anchors_all AS (
  SELECT uid, sender, pos::INTEGER AS pos, {title_expr('tag')} AS title,
         {link_expr('tag')} AS link
  FROM anchor_tags),
anchors AS (
  SELECT * FROM anchors_all
  WHERE length(title) >= {max(min_len, 1)} AND starts_with(link, '/'))"""


def normalise_address_sql(x: str) -> str:
    s1 = f"regexp_replace(coalesce({x}, ''), '\"(?:[^\"\\\\]|\\\\.)*\"', '', 'g')"
    s2 = f"regexp_replace({s1}, '\\([^()]*\\)', '', 'g')"
    s = f"regexp_replace({s2}, '^\\s+|\\s+$', '', 'g')"
    return s


def address_from(s: str) -> str:
    angles = f"regexp_extract_all({s}, '<([^<>]*)>', 1)"
    picked = (f"CASE WHEN contains({s}, ',') THEN '' "
              f"WHEN len({angles}) > 1 THEN '' "
              f"WHEN len({angles}) = 1 THEN regexp_replace({angles}[1], '^\\s+|\\s+$', '', 'g') "
              f"WHEN contains({s}, '<') OR contains({s}, '>') THEN '' "
              f"WHEN contains({s}, '@') OR NOT regexp_matches({s}, '\\s') THEN {s} "
              f"ELSE regexp_extract({s}, '^(\\S+)', 1) END")
    return picked


DATE_RE = (r"^(?:[A-Za-z]+,?\s+)?(\d{1,2})\s+([A-Za-z]+)\s+(\d{2,4})\s+"
           r"(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?(?:\s+([+-]\d{4}|[A-Za-z]+))?$")


def mail_header_sql(ts: str, key: str) -> str:
    full = f"strftime({ts}, '%a, %-d %b %Y %H:%M:%S')"
    plain = f"strftime({ts}, '%-d %b %Y %H:%M:%S')"
    plus1 = f"strftime({ts} + INTERVAL 1 HOUR, '%-d %b %Y %H:%M')"
    m530 = f"strftime({ts} - INTERVAL 330 MINUTE, '%-d %b %y %H:%M:%S')"
    return (f"CASE {key} % 8 WHEN 0 THEN {full} || ' +0000' WHEN 1 THEN {plus1} || ' +0100' "
            f"WHEN 2 THEN {full} || ' GMT' WHEN 3 THEN {plain} || ' -0000' WHEN 4 THEN {plain} "
            f"WHEN 5 THEN {m530} || ' -0530' WHEN 6 THEN {full} || ' +0000 (UTC)' "
            f"ELSE 'not a date ' || {key} END")


def parsed_date_cte(src: str, cols: str, hdr: str = "date_hdr") -> str:
    """CTEs ``d1..d3`` ending in ``parsed(<cols>, ts, zoned, offset_min, wall_date)``."""
    zones = " ".join(f"WHEN {q(k)} THEN {v}" for k, v in ZONE_NAMES.items())
    return f"""
d1 AS (
  SELECT {cols},
         regexp_replace(trim(regexp_replace(regexp_replace({hdr}, '\\([^()]*\\)', ' ', 'g'),
                        '\\s+', ' ', 'g')), '^\\s+|\\s+$', '', 'g') AS s
  FROM {src}),
d2 AS (
  SELECT {cols}, regexp_matches(s, '{DATE_RE}') AS ok,
         regexp_extract(s, '{DATE_RE}', ['dd','mon','yy','hh','mi','ss','zone']) AS g
  FROM d1),
d3 AS (
  SELECT {cols}, ok,
    TRY_CAST(g.dd AS INTEGER) AS dd,
    CASE WHEN coalesce(list_position({lst(MONTHS_SHORT)}, lower(g.mon)), 0) > 0
           THEN list_position({lst(MONTHS_SHORT)}, lower(g.mon))
         WHEN coalesce(list_position({lst(MONTHS_LONG)}, lower(g.mon)), 0) > 0
           THEN list_position({lst(MONTHS_LONG)}, lower(g.mon)) END AS mm,
    CASE WHEN length(g.yy) > 2 THEN TRY_CAST(g.yy AS INTEGER)
         WHEN TRY_CAST(g.yy AS INTEGER) > 68 THEN TRY_CAST(g.yy AS INTEGER) + 1900
         ELSE TRY_CAST(g.yy AS INTEGER) + 2000 END AS yr,
    TRY_CAST(g.hh AS INTEGER) AS hh, TRY_CAST(g.mi AS INTEGER) AS mi,
    CASE WHEN g.ss = '' THEN 0 ELSE TRY_CAST(g.ss AS INTEGER) END AS ss,
    upper(g.zone) AS zone
  FROM d2),
d4 AS (
  SELECT {cols}, ok, ss,
    TRY(make_timestamp(yr, mm, dd, hh, mi, ss::DOUBLE)) AS wall,
    CASE WHEN zone = '-0000' THEN NULL
         WHEN regexp_matches(zone, '^[+-]\\d{{4}}$')
           THEN (CASE WHEN substr(zone, 1, 1) = '-' THEN -1 ELSE 1 END)
                * (TRY_CAST(substr(zone, 2, 2) AS INTEGER) * 60
                   + TRY_CAST(substr(zone, 4, 2) AS INTEGER))
         ELSE CASE zone {zones} END END::INTEGER AS off
  FROM d3),
parsed AS (
  SELECT {cols},
    CASE WHEN ok AND wall IS NOT NULL AND ss < 60 THEN
      CASE WHEN off IS NULL THEN wall ELSE wall - to_minutes(off) END END AS ts,
    CASE WHEN ok AND wall IS NOT NULL AND ss < 60 THEN off IS NOT NULL END AS zoned,
    CASE WHEN ok AND wall IS NOT NULL AND ss < 60 THEN off END AS offset_min,
    CASE WHEN ok AND wall IS NOT NULL AND ss < 60 THEN wall::DATE END AS wall_date
  FROM d4)"""


def doc_items_cte() -> str:
    return """
doc_items AS (
  SELECT doc_id, lang, source, split_part(text, chr(10), 1) AS title,
         'doc://' || source || '/' || doc_id AS link,
         CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) END
           AS abstract
  FROM documents)"""


def blob(title="title", abstract="abstract") -> str:
    return f"lower({title} || ' ' || coalesce({abstract}, ''))"


def any_term(terms, b: str) -> str:
    return "(" + " OR ".join(f"contains({b}, {q(t)})" for t in terms) + ")"


PART_BYTES = 33554432  # a report's text is cut before the item that begins at a multiple of it


def numbered_docs_cte(terms=None, entry: str = "''", sep: int = 0, part: int = PART_BYTES) -> str:
    """Numbered items and the part of their report's text that each stands in (``chunked``)."""
    where = f"WHERE {any_term(terms, blob())}" if terms else ""
    return doc_items_cte() + f""",
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id)::INTEGER AS ordinal
  FROM doc_items {where}),
chunked AS (
  SELECT *, (coalesce(sum(strlen({entry}) + {sep}) OVER (
               PARTITION BY lang ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             // {part})::INTEGER AS chunk FROM numbered)"""


def entry_sql(label: str, trailing_blank: bool) -> str:
    abs_line = ("CASE WHEN abstract IS NOT NULL AND abstract <> '' "
                "THEN '   Abstract: ' || abstract || chr(10) ELSE '' END")
    tail = " || chr(10)" if trailing_blank else ""
    return (f"ordinal || '. {label}' || coalesce(title, '') || chr(10) || "
            f"'   Link: ' || coalesce(link, '') || chr(10) || {abs_line}{tail}")


def esc(x: str, amp: bool = False) -> str:
    if amp:
        x = f"replace({x}, '&', '&amp;')"
    return f"replace(replace({x}, '<', '&lt;'), '>', '&gt;')"


def preview(terms, n: int) -> str:
    more = "..." if len(terms) > n else ""
    return q(", ".join(terms[:n]) + more)


def tail_drop(src: str, part: str = "") -> str:
    p = f"PARTITION BY {part} " if part else ""
    return f"""(SELECT * FROM (
  SELECT *, row_number() OVER ({p}ORDER BY uid ASC, pos DESC) AS rr,
         count(*) OVER ({p.strip()}) AS n
  FROM {src}) WHERE NOT (n >= 2 AND rr <= 2))"""


UL_BLOCK = (r"regexp_replace(regexp_replace(regexp_extract(html, '(?is)<ul\b[^>]*>(.*?)</ul\s*>', 1),"
            r" '(?s)<!--.*?-->', '', 'g'), " f"'(?s)({WS}*<[^>]*>{WS}*)+', ' ', 'g')")


def block_abstract_cte() -> str:
    return f"""
blocks AS (
  SELECT page_id AS uid, {strip(decode(UL_BLOCK))} AS block_text FROM pages),
anchors_ctx AS (
  SELECT a.*, NULLIF({strip("replace(b.block_text, a.title, '')")}, '') AS abstract
  FROM anchors a JOIN blocks b USING (uid))"""


def _whole_lists() -> str:
    return f"""WITH {numbered_docs_cte()}
SELECT lang, {q(LIST_HEADING)} || chr(10) || chr(10) ||
       string_agg({entry_sql('', True)}, '' ORDER BY ordinal) AS markdown
FROM numbered GROUP BY lang"""


def _sql(part: int = PART_BYTES) -> dict[str, str]:
    out: dict[str, str] = {}
    out["latest_messages"] = (
        "SELECT event_id, ts, event_type FROM events ORDER BY event_id DESC LIMIT 100")
    out["latest_per_type"] = (
        "SELECT event_id, ts, event_type FROM events "
        "QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) <= 10")
    out["latest_then_filter"] = (
        "SELECT * FROM (SELECT event_id, ts, event_type FROM events "
        "ORDER BY event_id DESC LIMIT 100) WHERE event_type IN ('click', 'purchase')")
    out["terms_normalised"] = f"""
SELECT p_partkey, raw, array_to_string(l, '|') AS terms, len(l)::INTEGER AS n_terms FROM (
  SELECT p_partkey, raw,
         list_filter(list_transform(string_split(raw, ','), lambda x: lower({strip('x')})),
                     lambda x: x <> '') AS l
  FROM (SELECT p_partkey, concat_ws(',', p_name, '  ' || upper(p_type) || ' ', '', p_brand) AS raw
        FROM part))"""
    out["flags_parsed"] = """
SELECT o_orderkey, flag_raw,
       lower(coalesce(flag_raw, 'false')) IN ('true', '1', 'yes', 'on') AS flag,
       lower(coalesce(flag_raw, 'true')) IN ('true', '1', 'yes', 'on') AS flag_default_true
FROM (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'TRUE' WHEN 1 THEN ' yes'
        WHEN 2 THEN 'On' WHEN 3 THEN '1' WHEN 5 THEN 'no' END AS flag_raw FROM orders)"""
    out["headers_projected"] = f"""
SELECT uid, coalesce("from", '') AS "from", coalesce(subject, '') AS subject,
       coalesce(date, '') AS date
FROM (SELECT page_id AS uid,
        CASE WHEN page_id % 7 = 0 THEN NULL ELSE 'Alerts <alerts@' || {host('url')} || '>' END
          AS "from",
        CASE WHEN page_id % 5 = 0 THEN NULL
             ELSE regexp_extract(html, '(?is)<title>(.*?)</title>', 1) END AS subject,
        CASE WHEN page_id % 3 = 0 THEN NULL ELSE 'page ' || page_id END AS date
      FROM pages)
WHERE "from" IS NOT NULL OR subject IS NOT NULL OR date IS NOT NULL"""
    from_hdr = ("CASE c_custkey % 6 "
                "WHEN 0 THEN c_name || ' <' || upper(c_mktsegment) || '.' || c_custkey || '@Example.COM>' "
                "WHEN 1 THEN lower(c_mktsegment) || c_custkey || '@example.com' "
                "WHEN 2 THEN '\"' || c_name || ', Jr\" <x' || c_custkey || '@Mail.Example.org>' "
                "WHEN 3 THEN 'a' || c_custkey || '@x.com, b@y.com' "
                "WHEN 4 THEN 'User' || c_custkey || '@Example.com (' || c_name || ')' "
                "ELSE '<>' END")
    out["sender_normalised"] = f"""
SELECT c_custkey, from_hdr,
       CASE WHEN regexp_matches(picked, '@$') THEN '' ELSE lower(picked) END AS address
FROM (SELECT c_custkey, from_hdr, {address_from('s')} AS picked
      FROM (SELECT c_custkey, from_hdr, {normalise_address_sql('from_hdr')} AS s
            FROM (SELECT c_custkey, {from_hdr} AS from_hdr FROM customer)))"""
    ts0 = "(o_orderdate + to_seconds(o_orderkey % 86400))"
    out["mail_date_parsed"] = f"""
WITH hdrs AS (SELECT o_orderkey, {mail_header_sql(ts0, 'o_orderkey')} AS date_hdr FROM orders),
{parsed_date_cte('hdrs', 'o_orderkey, date_hdr')}
SELECT o_orderkey, date_hdr, ts, zoned, offset_min, wall_date FROM parsed"""
    out["run_day_messages"] = f"""
WITH hdrs AS (SELECT event_id, ts AS ev_ts, {mail_header_sql('ts', 'event_id')} AS date_hdr
              FROM events),
{parsed_date_cte('hdrs', 'event_id, ev_ts, date_hdr')}
SELECT event_id, ev_ts AS ts, date_hdr FROM parsed
WHERE (CASE WHEN zoned THEN ts::DATE ELSE wall_date END) = DATE '2024-01-07'"""
    out["messages_ranked"] = """
SELECT ts::DATE AS day, event_id, event_type, props,
       row_number() OVER (PARTITION BY ts::DATE ORDER BY event_id DESC)::INTEGER AS msg_rank
FROM events"""
    role_ct = ("CASE role WHEN 'assistant' THEN 'text/html' WHEN 'user' THEN 'text/plain' "
               "ELSE 'application/json' END")
    out["body_chosen"] = f"""
WITH p AS (SELECT conv_id AS uid, turn AS part_no, {role_ct} AS ct, text FROM conversations),
b AS (SELECT uid,
        arg_min(text, part_no) FILTER (WHERE ct = 'text/html' AND text IS NOT NULL) AS h,
        count(*) FILTER (WHERE ct = 'text/html' AND text IS NOT NULL) AS nh,
        arg_min(text, part_no) FILTER (WHERE ct = 'text/plain' AND text IS NOT NULL) AS pl,
        count(*) FILTER (WHERE ct = 'text/plain' AND text IS NOT NULL) AS np
      FROM p GROUP BY uid)
SELECT uid, html FROM (
  SELECT uid, CASE WHEN nh > 0 THEN h
                   WHEN np > 0 THEN {q(PLAIN_PREFIX)} || pl || {q(PLAIN_SUFFIX)}
                   ELSE '' END AS html FROM b)
WHERE html <> ''"""
    out["parts_exploded"] = f"""
SELECT conv_id * 100 + turn AS uid, 'conv' || conv_id || '@example.org' AS sender,
       'turn ' || turn AS subject, 1 AS part_no, 'N' AS multipart, {role_ct} AS content_type,
       'utf-8' AS charset, text
FROM conversations"""
    out["message_bodies"] = f"""
SELECT conv_id * 100 + turn AS uid,
       CASE role WHEN 'assistant' THEN text ELSE {q(PLAIN_PREFIX)} || text || {q(PLAIN_SUFFIX)} END
         AS html
FROM conversations WHERE role IN ('assistant', 'user') AND text <> ''"""
    mails = f"""
SELECT page_id AS uid, 'Site alerts <alerts@' || upper({host('url')}) || '>' AS "from",
       'page ' || page_id AS subject,
       strftime(TIMESTAMP '2025-11-19 00:00:00' + to_minutes(page_id), '%a, %-d %b %Y %H:%M:%S')
         || ' +0000' AS "date", md5(html) AS html_md5
FROM pages"""
    out["archive_scanned"] = mails
    out["archive_streamed"] = mails
    out["anchors_extracted"] = f"WITH {anchors_cte()}\nSELECT uid, pos, title, link FROM anchors"
    out["anchors_parsed"] = (f"WITH {anchors_cte()}\n"
                             "SELECT uid, pos, title, link, NULL::VARCHAR AS abstract FROM anchors")
    out["titles_removed"] = f"""WITH {anchors_cte()},{block_abstract_cte()}
SELECT uid, pos, title, link, abstract FROM anchors_ctx
QUALIFY row_number() OVER (PARTITION BY uid, title, link ORDER BY pos) = 1"""
    out["items_deduped_per_message"] = f"""WITH {anchors_cte(min_len=1)}
SELECT uid, pos, title, link FROM anchors
QUALIFY row_number() OVER (PARTITION BY uid, title, link ORDER BY pos) = 1"""
    dedup = """
dedup AS (SELECT * FROM anchors
          QUALIFY row_number() OVER (PARTITION BY title, link ORDER BY uid DESC, pos) = 1)"""
    out["items_deduped"] = f"WITH {anchors_cte()},{dedup}\nSELECT uid, pos, title, link FROM dedup"
    out["items_tail_dropped"] = (f"WITH {anchors_cte()},{dedup}\n"
                                 f"SELECT uid, pos, title, link FROM {tail_drop('dedup')}")
    dedup_s = """
dedup AS (SELECT * FROM anchors
          QUALIFY row_number() OVER (PARTITION BY sender, title, link ORDER BY uid DESC, pos) = 1)"""
    out["items_tail_dropped_by_sender"] = (
        f"WITH {anchors_cte()},{dedup_s}\n"
        f"SELECT sender, uid, pos, title, link FROM {tail_drop('dedup', 'sender')}")
    out["keyword_selected"] = (f"WITH {doc_items_cte()}\nSELECT doc_id, source, title FROM doc_items "
                               f"WHERE {any_term(S.DOC_TERMS, blob())}")
    out["keyword_selected_table"] = f"""WITH {doc_items_cte()},
terms AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '(\\p{{L}}{{6,}})', 1))) AS term
          FROM benchmark)
SELECT doc_id, source, title FROM doc_items d
WHERE EXISTS (SELECT 1 FROM terms t WHERE t.term <> '' AND contains({blob('d.title', 'd.abstract')}, t.term))"""
    out["items_null_keys"] = """
WITH d AS (SELECT CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE source END AS report,
                  doc_id % 4 AS box, doc_id // 4 AS uid, md5(text) AS text_md5 FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY report ORDER BY box DESC, uid ASC) AS rr,
             count(*) OVER (PARTITION BY report) AS n FROM d)
SELECT report, box, uid, text_md5,
       row_number() OVER (PARTITION BY report ORDER BY box, uid DESC)::INTEGER AS ordinal
FROM r WHERE NOT (n >= 2 AND rr <= 2)"""
    each = "regexp_replace(line, '[<>&]', ' ', 'g')"
    out["siblings_of_lines"] = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, unnest(generate_series(1, len(ls))) AS n FROM split)
SELECT doc_id AS uid, n::INTEGER AS pos, 'item ' || doc_id || ' line ' || n AS title,
       '/' || doc_id || '/' || n AS link, {strip(each)} AS abstract FROM lines"""
    out["items_numbered"] = """
SELECT source, doc_id, md5(text) AS text_md5, row_number() OVER (PARTITION BY source ORDER BY doc_id)::INTEGER AS ordinal
FROM documents"""
    sel_s = f"""
saved AS {tail_drop('dedup', 'sender')},
selected AS (SELECT * FROM saved WHERE {any_term(S.PAGE_TERMS, "lower(title || ' ')")})"""
    out["report_totals"] = (f"WITH {anchors_cte()},{dedup_s},{sel_s}\n"
                            "SELECT sender, count(*) AS total FROM selected GROUP BY sender")
    out["stage_funnel"] = f"""WITH {anchors_cte()},{dedup_s},{sel_s}
SELECT sender, 1 AS stage_no, 'scanned' AS stage, count(*) AS n FROM page_msgs GROUP BY sender
UNION ALL SELECT sender, 2, 'items', count(*) FROM anchors GROUP BY sender
UNION ALL SELECT sender, 3, 'unique', count(*) FROM dedup GROUP BY sender
UNION ALL SELECT sender, 4, 'saved', count(*) FROM saved GROUP BY sender
UNION ALL SELECT sender, 5, 'selected', count(*) FROM selected GROUP BY sender"""
    head = PROMPT_HEAD.format(terms="; ".join(S.REPORT_TERMS))
    in_prompt = entry_sql("Title: ", False)
    prompt = (f"CASE WHEN chunk = 0 THEN {q(head)} ELSE '' END || chr(10) || "
              f"string_agg({in_prompt}, chr(10) ORDER BY ordinal)")
    out["prompt_text"] = f"""WITH {numbered_docs_cte(None, in_prompt, 1, part)}
SELECT lang, chunk, count(*) AS n_items, {prompt} AS prompt
FROM chunked GROUP BY lang, chunk"""
    in_list = entry_sql("", True)
    out["item_list_text"] = f"""WITH {numbered_docs_cte(None, in_list, 0, part)}
SELECT lang, chunk, count(*) AS n_items,
       CASE WHEN chunk = 0 THEN {q(LIST_HEADING)} || chr(10) || chr(10) ELSE '' END ||
       string_agg({in_list}, '' ORDER BY ordinal) AS markdown
FROM chunked GROUP BY lang, chunk"""
    terms = list(S.REPORT_TERMS)
    out["report_metadata"] = f"""WITH {numbered_docs_cte(terms)}
SELECT lang, count(*) AS total, {preview(terms, 5)} AS keywords_preview,
       {preview(terms, 3)} AS footer_keywords,
       strftime(TIMESTAMP '{S.GENERATED_AT}', '%B %d, %Y at %I:%M %p') AS generated_on
FROM numbered GROUP BY lang"""
    badges = q("".join(f"<kbd>{t}</kbd>" for t in terms))
    note = esc("coalesce(abstract, '')")
    entry_html = (
        "'<article><h4><a href=\"' || coalesce(link, '') || '\">' || " + esc("coalesce(title, '')")
        + f" || '</a></h4>' || CASE WHEN {note} <> '' THEN '<p>' || {note} || '</p>' ELSE '' END "
        "|| '</article>'")
    out["items_panel"] = f"""WITH {numbered_docs_cte(terms, entry_html, 1, part)}
SELECT lang, chunk, count(*) AS n_items, {badges} AS badges,
       CASE WHEN chunk > 0 THEN chr(10) ELSE '' END ||
       string_agg({entry_html}, chr(10) ORDER BY ordinal) AS items_html
FROM chunked GROUP BY lang, chunk"""
    prompts = f"""
prompts AS (
  SELECT lang, chunk, {prompt} AS prompt FROM chunked GROUP BY lang, chunk),
summ AS (
  SELECT lang, chunk, 'echo' AS backend,
         'summary of ' || (length(prompt) - length(replace(prompt, chr(10), '')) + 1)
         || ' lines, ' || length(prompt) || ' characters' AS summary,
         NULL::VARCHAR AS error
  FROM prompts)"""
    out["summaries"] = f"""WITH {numbered_docs_cte(terms, in_prompt, 1, part)},{prompts}
SELECT lang, chunk, backend, summary, error FROM summ"""
    meta = f"""
meta AS (
  SELECT lang, count(*) AS total, {preview(terms, 5)} AS keywords_preview,
         {preview(terms, 3)} AS footer_keywords,
         strftime(TIMESTAMP '{S.GENERATED_AT}', '%B %d, %Y at %I:%M %p') AS generated_on
  FROM numbered GROUP BY lang)"""
    title = "Research digest"
    above = (
        "'<!DOCTYPE html>' || chr(10) || '<html lang=\"en\">' || chr(10) || "
        f"'<head><meta charset=\"UTF-8\"><title>' || {q(title + ' - ')} || lang || "
        "'</title><style>body{font-family:sans-serif;max-width:60em;margin:auto}"
        ".md{white-space:pre-wrap}</style></head>' || chr(10) || '<body>' || chr(10) || "
        f"'<h1>' || {q(title)} || '</h1>' || chr(10) || '<dl><dt>Report</dt><dd>' || lang || "
        f"'</dd><dt>Keywords</dt><dd>' || {esc('keywords_preview', True)} || "
        "'</dd><dt>Total items</dt><dd>' || total || '</dd></dl>' || chr(10) || '<div class=\"md\">'")
    below = (
        "'</div>' || chr(10) || '<footer><p>Generated on ' || generated_on || '</p><p>' || total || "
        f"' items in this digest; terms: ' || {esc('footer_keywords', True)} || "
        "'</p></footer>' || chr(10) || '</body>' || chr(10) || '</html>' || chr(10)")
    out["report_html"] = f"""WITH {numbered_docs_cte(terms, in_prompt, 1, part)},{prompts},{meta}
SELECT lang, chunk, CASE WHEN chunk = min(chunk) OVER (PARTITION BY lang) THEN {above} ELSE chr(10) END
       || {esc('summary', True)}
       || CASE WHEN chunk = max(chunk) OVER (PARTITION BY lang) THEN {below} ELSE '' END AS html
FROM meta JOIN summ USING (lang)"""
    saved = f"WITH {anchors_cte()},{dedup_s},\nsaved AS {tail_drop('dedup', 'sender')}\n"
    out["items_filed"] = (saved + "SELECT 'is-' || sender AS report, title, link, "
                          "NULL::VARCHAR AS abstract FROM saved")
    out["lists_filed"] = (f"SELECT 'is-' || lang AS report, md5(CASE WHEN markdown LIKE '%' || chr(10) "
                          f"THEN markdown ELSE markdown || chr(10) END) AS text_md5 "
                          f"FROM ({_whole_lists()})")
    out["prompts_filed"] = f"SELECT lang, chunk, prompt AS text FROM ({out['prompt_text']})"
    out["summaries_filed"] = ("SELECT 'is-' || lang || '~is-echo' AS report, lang, chunk, backend, "
                              f"summary, error FROM ({out['summaries']})")
    rerun = any_term(S.RERUN_TERMS, "lower(title || ' ')")
    out["reports_rerun"] = saved + ("SELECT 'is-' || sender AS report, sender, uid, pos, title "
                                    f"FROM saved WHERE {rerun}")
    head_re = r"^(#{1,6})[ \t]+(.*?)[ \t]*#*[ \t]*$"
    out["markdown_outline"] = f"""
WITH md AS (
  SELECT conv_id, turn,
         '## ' || role || ' turn ' || turn || chr(10) || regexp_replace(text, '(?m)^', '### ', 'g')
           AS markdown
  FROM conversations),
lines AS (
  SELECT conv_id, turn, unnest(string_split(markdown, chr(10))) AS line,
         unnest(generate_series(1, len(string_split(markdown, chr(10))))) AS line_no
  FROM md),
heads AS (
  SELECT conv_id, turn, line_no::INTEGER AS line_no,
         length(regexp_extract(line, '{head_re}', 1))::INTEGER AS level,
         {strip(f"regexp_extract(line, '{head_re}', 2)")} AS heading
  FROM lines WHERE regexp_matches(line, '{head_re}')),
based AS (
  SELECT *, regexp_replace(trim(regexp_replace(lower(heading), '[^a-z0-9_\\s-]', '', 'g')),
                           '[\\s-]+', '-', 'g') AS base
  FROM heads)
SELECT conv_id, turn, line_no, level, heading,
       CASE WHEN row_number() OVER (PARTITION BY conv_id, turn, base ORDER BY line_no) = 1
            THEN base
            ELSE base || '_' || (row_number() OVER (PARTITION BY conv_id, turn, base
                                                   ORDER BY line_no) - 1) END AS slug,
       last_value(CASE WHEN level = 2 THEN heading END IGNORE NULLS) OVER (
         PARTITION BY conv_id, turn ORDER BY line_no
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section
FROM based"""

    def digest_sql(part: str = "", latest: int = 0, parsed: bool = False,
                   where: str = "") -> str:
        extra = where
        if latest:
            extra = (f"WHERE uid IN (SELECT page_id FROM pages ORDER BY page_id DESC "
                     f"LIMIT {latest})")
        p = part + ", " if part else ""
        by = part or "report_date"
        src = "anchors_ctx" if parsed else "anchors_r"
        abstract = "abstract" if parsed else "NULL::VARCHAR AS abstract"
        ctx = ("," + block_abstract_cte().replace("FROM anchors a", "FROM anchors_r a")
               if parsed else "")
        return f"""WITH {anchors_cte(extra=extra)},
anchors_r AS (SELECT *, DATE '{S.RUN_DATE}' AS report_date FROM anchors){ctx},
items AS (SELECT uid, sender, report_date, pos, title, link, {abstract} FROM {src}),
dedup AS (SELECT * FROM items
          QUALIFY row_number() OVER (PARTITION BY {p}title, link ORDER BY uid DESC, pos) = 1),
saved AS {tail_drop('dedup', by)},
selected AS (SELECT * FROM saved WHERE {any_term(S.PAGE_TERMS, blob())})
SELECT {by}, row_number() OVER (PARTITION BY {by} ORDER BY uid DESC, pos)::INTEGER AS ordinal,
       uid, pos, title, link, abstract
FROM selected"""

    out["digest"] = digest_sql("report_date")
    out["digest_latest"] = digest_sql("report_date", latest=100)
    out["digest_by_sender"] = digest_sql("sender")
    out["digest_parsed"] = digest_sql("report_date", parsed=True)
    out["digest_incremental"] = out["digest"]
    out["digest_incremental_latest"] = out["digest_latest"]
    out["digest_raw"] = digest_sql("report_date", where="WHERE starts_with(sender, 'blog.')")
    return out


ORACLE_SQL: dict[str, str] = _sql()
