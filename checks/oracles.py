"""For each query, SQL for DuckDB on the same tables. Every statement runs over whole tables."""

from __future__ import annotations

from checks.corpus import ARTICLES, DATE_TEXTS, DIM, LINK_PAGES, LINKED_PAGES, MARKED_PAGES
from newsflow.functions import people
from newsflow.functions.dates import DATE_SHAPES
from newsflow.functions.ids import DNS_NAMESPACE
from newsflow.functions.text import CHUNK_LEAD, SPACE_CHARS, SPACE_CLASS
from newsflow.operators import retrieval
from newsflow.operators.chunks import CHUNK_OVERLAP, CHUNK_SIZE
from newsflow.operators.evaluation import EPSILON, METRICS, NO_ANSWER

ORACLES: dict[str, str] = {}


def text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {text(SPACE_CHARS)})"


def collapse(x: str) -> str:
    return f"regexp_replace({x}, {text(SPACE_CLASS + '+')}, ' ', 'g')"


# What a document's article has behind its text, and the names it gives, are known by its number.
JUNK = " Ảnh: AFP. Bản quyền thuộc về Báo."
CLEAN = f"trim({collapse(f'CASE doc_id % 7 WHEN 0 THEN left(content, length(content) - {len(JUNK)}) ELSE content END')}, ' ')"
NAMES = """CASE doc_id % 10 WHEN 0 THEN ['Unknown'] WHEN 1 THEN ['Unknown'] WHEN 2 THEN ['An Lan'] WHEN 3 THEN ['Minh', 'Tú', 'Hà']
  ELSE ['Author ' || CAST(doc_id % 37 AS VARCHAR)] END"""


def with_(*parts: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n"


ART = f"articles AS ({ARTICLES.format(documents='documents')})"
LINKED = f"linked AS ({LINKED_PAGES.format(pages=f'({LINK_PAGES.format(pages="pages")})')})"
LABELLED = "labelled AS (SELECT a.* FROM articles a WHERE doc_id IN (SELECT doc_id FROM labels))"

# Sources

ORACLES["read_seeds"] = "SELECT url FROM pages UNION ALL SELECT url || '#seed' FROM pages"
ORACLES["read_pages"] = "SELECT page_id, url, md5(html) AS html FROM pages"
ORACLES["read_topic"] = with_(ART) + """
SELECT url, source, author, publish_date, md5(title) AS title, md5(content) AS content FROM articles"""
ORACLES["peek_topic"] = """
SELECT seq, status, title FROM (
  SELECT -item_id * 4 - 1 AS seq, 'bad' AS status, 'Unknown Title' AS title FROM benchmark
  UNION ALL SELECT -item_id * 4 - 2, 'bad', 'Unknown Title' FROM benchmark
  UNION ALL SELECT -item_id * 4 - 3, 'skipped', text FROM benchmark
  UNION ALL SELECT -item_id * 4 - 4, 'skipped', text FROM benchmark) ORDER BY seq LIMIT 5"""
PAIRS = """pairs AS (
  SELECT u.conv_id, u.turn, u.text AS question, a.text AS ground_truth
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""
ORACLES["read_testset"] = with_(PAIRS) + "SELECT question, ground_truth FROM pairs"
VERDICTS = """verdicts AS (
  SELECT d.source AS model, CAST(floor(l.doc_id / 5) AS BIGINT) AS query_id, CAST(l.doc_id % 5 + 1 AS INTEGER) AS rank,
         l.quality AS verdict, l.toxic, d.n_chars, l.doc_id
  FROM labels l JOIN documents d USING (doc_id))"""
ORACLES["write_scores"] = with_(VERDICTS) + """
SELECT model, query_id, round(avg(verdict), 6) AS faithfulness FROM verdicts GROUP BY ALL"""
ORACLES["faithfulness"] = ORACLES["write_scores"]


def point_id(article: str, index: str) -> str:
    digest = f"sha1(unhex('{DNS_NAMESPACE}') || encode('article_' || {article} || '_chunk_' || {index}))"
    return (f"(SELECT h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || translate(h[17:17], '0123456789abcdef', "
            f"'89ab89ab89ab89ab') || h[18:20] || '-' || h[21:32] FROM (SELECT {digest} AS h))")


ORACLES["upsert_points"] = with_(ART, LABELLED, f"named AS (SELECT *, {point_id('doc_id', '0')} AS id FROM articles)") + """
SELECT id, 'new' AS version, url FROM named
UNION ALL SELECT id || '-gone', 'old', url FROM named"""

# Links

# The given pages have plain links only; what was put in front of the footer is known by page_id.
RAW_LINKS = r"""raw AS (
  SELECT page_id, url, generate_subscripts(hrefs, 1) - 1 AS position, unnest(hrefs) AS href FROM (
    SELECT page_id, url, list_concat(regexp_extract_all(html, '<a href="([^"]*)"', 1), CASE page_id % 6
      WHEN 0 THEN ['/unquoted.html'] WHEN 1 THEN ['/x?a=1&b=2&c=é'] WHEN 3 THEN [' /lead.html'] WHEN 4 THEN ['/single']
      ELSE [] END) AS hrefs FROM {pages}))"""
PLAIN_LINKED = """plain_linked AS (
  SELECT page_id, 'https://news.example.com/' || split_part(regexp_extract(html, '<title>([^<]*)', 1), ' ', 1) AS url, html FROM pages)"""
KINDS = r"""follow AS (SELECT * FROM raw WHERE NOT regexp_matches(href, '^(mailto:|tel:|javascript:|#)')),
resolved AS (
  SELECT *, regexp_extract(url, '^[a-z]+://[^/?#]*') || ltrim(href) AS dst_url,
         regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host FROM follow),
kinds AS (
  SELECT *, CASE WHEN regexp_matches(dst_url, '\.html|\.htm|\.amp') THEN 'article'
                 WHEN len(string_split(replace(dst_url, 'https://' || host, ''), '/')) <= 3 THEN 'category' END AS kind
  FROM resolved WHERE contains(dst_url, host))"""
LINKS = RAW_LINKS.format(pages="pages")
POSITION = "page_id, CAST(position AS INTEGER) AS position, href"
ORACLES["lnk_1"] = with_(LINKS) + f"SELECT {POSITION} FROM raw"
ORACLES["lnk_2"] = with_(LINKS, KINDS) + f"SELECT {POSITION} FROM follow"
ORACLES["lnk_3"] = with_(LINKS, KINDS) + f"SELECT {POSITION}, dst_url FROM resolved"
ORACLES["lnk_4"] = with_(LINKS, KINDS) + f"SELECT {POSITION}, dst_url FROM kinds"
ORACLES["extract_links"] = with_(LINKS, KINDS) + f"SELECT {POSITION}, dst_url, kind FROM kinds WHERE kind IS NOT NULL"
ORACLES["crawl_frontier"] = with_(LINKED, PLAIN_LINKED, RAW_LINKS.format(pages="plain_linked"), KINDS, """
edges AS (SELECT DISTINCT url AS src, dst_url AS dst, kind FROM kinds WHERE kind IS NOT NULL),
walk AS (
  SELECT min(url) AS url, 0 AS depth, 'seed' AS kind FROM linked
  UNION SELECT e.dst, w.depth + 1, e.kind FROM walk w JOIN edges e ON e.src = w.url
  WHERE w.depth < 5 AND w.kind <> 'article')""") + "SELECT url, min(depth) AS depth FROM walk GROUP BY url"
ORACLES["lnk_7"] = "SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS domain FROM pages"

# Articles from pages: the given pages hold h1, p, br and b in their article, without attributes; what was added is known by page_id.

AMP = "replace(replace({}, '&quot;', '\"'), '&amp;', '&')".format
PLAIN_TITLE = strip(collapse(AMP("split_part(split_part(html, '<title>', 2), '</title>', 1)")))
INNER = "split_part(split_part(html, '<article>', 2), '</article>', 1)"
NUMBER = "CAST(page_id % 13 AS VARCHAR)"
# per page_id % 16: paragraphs, and closing blocks (text, bold or right) that were added; the author the rules find
ADDED = {
    0: (f"['- Lan Anh ' || {NUMBER} || ' • 12/3']", f"[('- Lan Anh ' || {NUMBER} || ' • 12/3', false)]", f"'Lan Anh ' || {NUMBER}"),
    1: ("['Theo: Reuters']", "[('Theo: Reuters', false)]", None),
    2: ("['Minh Hà']", "[('Minh Hà', true)]", "'Minh Hà'"),
    3: ("['Tú Anh & Bình']", None, "'Tú Anh & Bình'"),
    4: ("['Quang 0912 345 678']", None, "'Quang'"),
    5: ("['Mayer', 'Thu Trang']", "[('Mayer', true), ('Thu Trang', true)]", None),
    6: ("['Menu Item']", "[('', false)]", None),
    7: ("['By Lan Anh']", "[('By Lan Anh', true)]", "'Lan Anh'"),
    8: ("['Hà My']", None, "'Hà My'"),
    9: ("['Bảo Ngọc – Lê']", "[('Bảo Ngọc – Lê', false)]", "'Bảo Ngọc – Lê'"),
    10: ("['x', 'Outside Bold']", "[('x', true), ('Outside Bold', true)]", None),
    11: ("['a', 'Lan Anh']", "[('a Lan Anh', true), ('a', false)]", None),
}
DATE_PARAGRAPHS = ("CASE page_id % 7 WHEN 0 THEN ['Thứ hai, 6/4/2026, 17:02'] WHEN 1 THEN ['cũ'] WHEN 2 THEN ['6-4-2026'] "
                   "WHEN 3 THEN ['1/1/2001'] WHEN 4 THEN ['Ngày 7/4/2026 08:15'] ELSE [] END")


def added(part: int, otherwise: str) -> str:
    cases = " ".join(f"WHEN {k} THEN {v[part]}" for k, v in ADDED.items() if v[part])
    return f"CASE page_id % 16 {cases} ELSE {otherwise} END"


def cut(x: str, *tags: str) -> str:
    for tag in tags:
        x = f"replace({x}, '{tag}', chr(1))"
    return f"string_split({x}, chr(1))"


MARKED = f"marked AS ({MARKED_PAGES.format(pages='pages')})"
TEXTS = f"""texts AS (
  SELECT page_id, (SELECT m.url FROM marked m WHERE m.page_id = p.page_id) AS url,
    CASE page_id % 3 WHEN 2 THEN 'Báo ảnh… &amp; ' ELSE '' END || {PLAIN_TITLE} AS title,
    array_to_string(list_concat(list_filter(list_transform({cut(INNER, '<h1>', '</h1>', '<p>', '</p>', '<br>')},
      lambda x: {strip(collapse(AMP("replace(replace(x, '<b>', ' '), '</b>', ' ')")))}), lambda x: x <> ''),
      list_concat({added(0, '[]')}, {DATE_PARAGRAPHS})), chr(10) || chr(10)) AS body
  FROM pages p)"""
ORACLES["ext_1"] = with_(MARKED, TEXTS) + "SELECT page_id, title, md5(body) AS text FROM texts"
ORACLES["ext_2"] = with_(MARKED, TEXTS) + """
SELECT page_id, CAST(length(body) AS INTEGER) AS n_chars FROM texts WHERE length(body) >= 100"""
ORACLES["ext_3"] = with_(ART) + rf"""
SELECT doc_id, {strip(r"array_to_string(regexp_split_to_array(author, ',|\s-\s'), ', ')")} AS author FROM articles"""


def valid(c: str) -> str:
    forbidden, starts = "|".join(people.FORBIDDEN_IN_NAME), "|".join(people.LONG_NAME_STARTS)
    return (f"coalesce(length({c}) BETWEEN 2 AND 100 AND NOT regexp_matches({strip(c)}, {text(people.HEADING)})"
            f" AND NOT contains({c}, '?') AND NOT contains({c}, '!')"
            f" AND length(regexp_replace({c}, '[^0-9]', '', 'g')) < 7"
            f" AND NOT regexp_matches({c}, {text(people.DATE_OR_CLOCK)})"
            f" AND (len(regexp_split_to_array({strip(c)}, {text(SPACE_CLASS + '+')})) <= 6"
            f" OR regexp_matches(lower({c}), ',|-|và|&') OR regexp_matches({strip(c)}, {text('(?i)^(?:' + starts + ')')}))"
            f" AND NOT regexp_matches(lower({c}), {text(forbidden)}), false)")


ORACLES["is_valid_author"] = with_(ART, f"""names AS (
  SELECT doc_id AS k, unnest([author, title, publish_date]) AS name FROM articles
  UNION ALL SELECT -page_id - 1, {PLAIN_TITLE} FROM pages)""") + f"""
SELECT k, md5(name) AS name, {valid('name')} AS valid FROM names"""


PARKED = """parked AS (
  SELECT page_id, CASE WHEN page_id % 5 = 1 THEN 'Writer ' || CAST(page_id % 41 AS VARCHAR) ELSE '' END AS author,
         CASE WHEN page_id % 5 = 0 THEN 'Dân trí' ELSE '' END AS parked FROM pages)"""
ORACLES["ext_5"] = with_(PARKED) + "SELECT page_id, author, parked FROM parked"
CASCADE = f"cascade AS (SELECT page_id, {added(2, 'NULL')} AS author FROM pages)"
ORACLES["ext_6"] = with_(CASCADE) + "SELECT page_id, author FROM cascade"

TAIL = f"""blocks AS (
  SELECT page_id, list_concat(list_transform(string_split({INNER}, '<p>')[2:], lambda x: row(
    {strip(collapse(AMP("replace(replace(replace(replace(x, '<b>', ''), '</b>', ''), '</p>', ''), '<br>', '')")))}, contains(x, '<b>'))),
    {added(1, '[]')}) AS nodes FROM pages),
tail_rows AS (SELECT page_id, -generate_subscripts(nodes, 1) AS pos, unnest(nodes) AS node FROM (
  SELECT page_id, nodes[greatest(len(nodes) - 14, 1):] AS nodes FROM blocks)),
tail_texts AS (SELECT page_id, pos, translate(node[1], '"“”', '') AS t, node[2] AS marked FROM tail_rows),
tail_named AS (SELECT *, {strip("regexp_extract(t, '(?i)(?:Nguồn|Theo|Source) *:? *(.+)', 1)")} AS named FROM tail_texts
               WHERE length(t) BETWEEN 2 AND 100),
tail_found AS (SELECT page_id, pos, CASE WHEN {valid('named')} THEN named
    WHEN marked AND {valid('t')} THEN t END AS author FROM tail_named),
tail AS (SELECT page_id, arg_min(author, pos) AS author FROM tail_found WHERE author IS NOT NULL GROUP BY page_id)"""
ORACLES["ext_7"] = with_(TAIL) + "SELECT p.page_id, t.author FROM pages p LEFT JOIN tail t USING (page_id)"

AUTHORS = ",\n".join([PARKED, CASCADE, TAIL, """
authors AS (
  SELECT p.page_id, coalesce(nullif(p.author, ''), c.author, t.author, nullif(p.parked, ''), 'Unknown') AS author
  FROM parked p JOIN cascade c USING (page_id) LEFT JOIN tail t USING (page_id))"""])
ORACLES["ext_8"] = with_(AUTHORS) + "SELECT page_id, author FROM authors"

# What the date rules find, in their order.
DATES = """date_rows AS (
  SELECT page_id, unnest([1, 2, 3, 4, 5, 6, 7]) AS pos, unnest([
    CASE WHEN page_id % 6 = 0 THEN '2026-04-06T19:33:59+07:00' END, CASE WHEN page_id % 7 = 1 THEN '14:29 06/02/2024' END,
    CASE WHEN page_id % 7 = 1 THEN 'cũ' END, CASE WHEN page_id % 6 = 1 THEN '31/02/2024, 10:00' END,
    CASE WHEN page_id % 7 = 4 THEN ' 7/4/2026 08:15' END, CASE WHEN page_id % 7 = 0 THEN 'Thứ hai, 6/4/2026, 17:02' END,
    CASE WHEN page_id % 7 = 2 THEN '6-4-2026' END]) AS raw FROM pages)"""
ORACLES["ext_9"] = with_(DATES) + """
SELECT page_id, coalesce(string_agg(raw, '|' ORDER BY pos), '') AS candidates FROM date_rows GROUP BY page_id"""


def moment(t: str) -> str:
    """The timestamp a date text stands for, NULL when there is none."""
    out = "CASE "
    for shape, groups in DATE_SHAPES:
        def part(name: str, width: int) -> str:
            if name not in groups:
                return "'00'"
            return f"lpad(regexp_extract({t}, {text(shape)}, {groups[name]}), {width}, '0')"
        out += (f"WHEN regexp_matches({t}, {text(shape)}) THEN try_strptime({part('y', 4)} || '-' || {part('m', 2)} || '-' || "
                f"{part('d', 2)} || ' ' || {part('h', 2)} || ':' || {part('mi', 2)}, '%Y-%m-%d %H:%M') ")
    return out + "END"


EVENT_DATES = f"""raws AS ({DATE_TEXTS.format(events='events')}),
neat AS (SELECT event_id, {strip(collapse('raw'))} AS t FROM raws)"""
ORACLES["parse_publish_date"] = with_(EVENT_DATES) + f"""
SELECT event_id, strftime({moment('t')}, '%Y-%m-%d %H:%M:%S') AS moment FROM neat"""

PAGE_DATES = DATES + f""",
date_texts AS (SELECT page_id, pos, {strip(collapse('raw'))} AS t FROM date_rows WHERE raw IS NOT NULL),
date_moments AS (SELECT page_id, pos, {moment('t')} AS ts FROM date_texts),
dates AS (SELECT page_id, strftime(arg_min(ts, pos), '%Y-%m-%d %H:%M:%S') AS d FROM date_moments WHERE ts IS NOT NULL
          GROUP BY page_id),
dated AS (SELECT page_id, coalesce(d, CASE WHEN page_id % 4 = 3 THEN '2023-11-05 00:00:00' END, 'Unknown') AS publish_date
          FROM pages LEFT JOIN dates USING (page_id))"""
ORACLES["ext_11"] = with_(PAGE_DATES) + "SELECT page_id, publish_date FROM dated"
ORACLES["extract_articles"] = with_(MARKED, TEXTS, AUTHORS, PAGE_DATES) + f"""
SELECT url, title, md5({strip('body')}) AS content, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS source, author, publish_date
FROM texts JOIN authors USING (page_id) JOIN dated USING (page_id) WHERE length(body) >= 100"""

# Ingest

TITLES = "CASE WHEN doc_id % 11 = 0 THEN 'Unknown Title' WHEN doc_id % 13 = 0 THEN NULL ELSE title END"
ORACLES["ing_1"] = """
SELECT doc_id * 2 AS seq, 'ok' AS status FROM documents
UNION ALL SELECT d.doc_id * 2 + 1, 'ok' FROM documents d SEMI JOIN labels USING (doc_id)
UNION ALL SELECT -item_id * 4 - 1, 'bad' FROM benchmark UNION ALL SELECT -item_id * 4 - 2, 'bad' FROM benchmark
UNION ALL SELECT -item_id * 4 - 3, 'skipped' FROM benchmark UNION ALL SELECT -item_id * 4 - 4, 'skipped' FROM benchmark"""
ORACLES["ing_2"] = with_(ART, LABELLED) + """
SELECT doc_id * 2 AS seq, url FROM articles UNION ALL SELECT doc_id * 2 + 1, url FROM labelled"""
ORACLES["ing_3"] = with_(ART, LABELLED) + f"""
SELECT doc_id * 2 AS seq, {TITLES} AS title, author, publish_date FROM articles
UNION ALL SELECT doc_id * 2 + 1, 'late', author, publish_date FROM labelled"""
ORACLES["url_key"] = with_(ART) + "SELECT doc_id, sha256(url) AS url_hash FROM articles"
META = f"meta AS (SELECT sha256(url) AS url_hash, url, {TITLES} AS title, author, publish_date, content, doc_id FROM articles)"
UNSEEN = "doc_id NOT IN (SELECT doc_id FROM labels)"
META_COLUMNS = "url_hash, url, title, author, publish_date, md5(content) AS content"
ORACLES["ingest_batch"] = with_(ART, META) + f"SELECT {META_COLUMNS} FROM meta WHERE {UNSEEN}"
ORACLES["ingest_articles"] = with_(ART, META) + f"SELECT {META_COLUMNS} FROM meta"
ORACLES["ingest_counters"] = f"SELECT status, count(*) AS n FROM ({ORACLES['ing_1']}) GROUP BY status"
ORACLES["article_count"] = "SELECT count(*) AS n_articles FROM documents"
ORACLES["read_metadata"] = with_(ART, META) + "SELECT url_hash, title, url, md5(content) AS content FROM meta"
ORACLES["reset_metadata"] = with_(ART, META) + "SELECT url_hash, title, url FROM meta WHERE doc_id IN (SELECT doc_id FROM labels)"

# Warehouse

DEDUP = "dedup AS (SELECT * FROM meta QUALIFY row_number() OVER (PARTITION BY title ORDER BY url_hash) = 1)"
GATE = "author NOT IN ('', 'Unknown') AND publish_date NOT IN ('', 'Unknown')"


LOADED = f"""loaded AS (
  SELECT url_hash, url, title, split_part(url, '/', 3) AS domain, doc_id,
         CAST(try_strptime(publish_date, '%Y-%m-%d %H:%M:%S') AS DATE) AS d, {NAMES} AS names,
         {CLEAN} AS content, row_number() OVER (ORDER BY url_hash) AS article_id
  FROM dedup WHERE {GATE}),
src AS (SELECT domain, row_number() OVER (ORDER BY domain) AS source_id FROM (SELECT DISTINCT domain FROM loaded)),
tim AS (SELECT d, row_number() OVER (ORDER BY d) AS time_id FROM (SELECT DISTINCT d FROM loaded WHERE d IS NOT NULL)),
written AS (SELECT DISTINCT article_id, unnest(names) AS author_name FROM loaded),
aut AS (SELECT author_name, row_number() OVER (ORDER BY author_name) AS author_id
        FROM (SELECT DISTINCT author_name FROM written)),
bridge AS (SELECT article_id, author_id FROM written JOIN aut USING (author_name)),
facts AS (SELECT article_id, url_hash, title, source_id, coalesce(time_id, 0) AS time_id, article_id AS content_id,
                 CAST(length(content) AS INTEGER) AS content_length
          FROM loaded JOIN src USING (domain) LEFT JOIN tim USING (d))"""
STAR = with_(ART, META, DEDUP, LOADED)
ORACLES["new_articles"] = with_(ART, META) + f"SELECT url_hash, title FROM meta WHERE {UNSEEN}"
ORACLES["dedup_titles"] = with_(ART, META, DEDUP) + "SELECT url_hash, title FROM dedup"
ORACLES["wh_3"] = with_(ART, META) + f"""
SELECT url_hash, author AS author_text, publish_date AS raw_date, md5(content) AS raw_content,
       CASE WHEN {GATE} THEN 'loaded' ELSE 'skipped' END AS state FROM meta"""
ORACLES["gate_articles"] = with_(ART, META) + f"SELECT url_hash FROM meta WHERE {GATE}"
CLEANED = f"cleaned AS (SELECT doc_id AS id, {CLEAN} AS content FROM articles)"
ORACLES["clean_text"] = with_(ART, CLEANED) + """
SELECT id AS doc_id, CAST(length(content) AS INTEGER) AS n_chars, md5(content) AS content FROM cleaned"""
ORACLES["split_authors"] = with_(ART) + f"SELECT doc_id, array_to_string({NAMES}, '|') AS authors FROM articles"
ORACLES["wh_7"] = with_(ART) + "SELECT doc_id, split_part(url, '/', 3) AS domain FROM articles"
ORACLES["dim_source"] = STAR + "SELECT source_id, domain FROM src"
ORACLES["dim_time"] = STAR + """
SELECT time_id, strftime(d, '%Y-%m-%d') AS date, CAST(day(d) AS INTEGER) AS day, CAST(month(d) AS INTEGER) AS month,
       CAST(year(d) AS INTEGER) AS year FROM tim
UNION ALL SELECT 0, NULL, NULL, NULL, NULL"""
ORACLES["dim_content"] = STAR + "SELECT article_id AS content_id, url_hash, md5(content) AS content FROM loaded"
ORACLES["dim_author"] = STAR + "SELECT author_id, author_name FROM aut"
ORACLES["fact_articles"] = STAR + "SELECT * FROM facts"
ORACLES["fact_article_authors"] = STAR + "SELECT * FROM bridge"
ORACLES["wh_12"] = STAR + """
SELECT 'dim_source' AS table_name, count(*) - count(DISTINCT domain) AS repeated FROM src
UNION ALL SELECT 'dim_time', count(*) - count(DISTINCT d) FROM tim
UNION ALL SELECT 'dim_content', count(*) - count(DISTINCT url_hash) FROM loaded
UNION ALL SELECT 'dim_author', count(*) - count(DISTINCT author_name) FROM aut
UNION ALL SELECT 'fact_articles', count(*) - count(DISTINCT url_hash) FROM facts
UNION ALL SELECT 'fact_article_authors', count(*) - count(DISTINCT (article_id, author_id)) FROM bridge
UNION ALL SELECT 'fact_chunks', 0"""
ORACLES["wh_13"] = with_(ART, META, DEDUP) + f"""
SELECT count(*) AS found, count(*) FILTER (WHERE {GATE}) AS loaded, count(*) FILTER (WHERE NOT ({GATE})) AS skipped,
       CAST(0 AS BIGINT) AS errors FROM dedup"""
ORACLES["run_etl"] = ORACLES["wh_13"]


def chunking(source: str) -> str:
    """CTE ``chunks(id, chunk_index, chunk)`` of cleaned texts (id, content): pieces at full stops, long ones again at
    spaces, longer ones still cut by length; runs of short pieces are packed greedily."""
    size, overlap = CHUNK_SIZE, CHUNK_OVERLAP
    step = size - overlap

    def pieces(name: str, base: str, owner: str, start: str, sep: str) -> str:
        return f"""{name} AS (SELECT id, piece, lo, lo + n AS hi, n FROM (
  SELECT id, piece, n, base + coalesce(sum(n) OVER (PARTITION BY id, piece ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING
         AND 1 PRECEDING), 0) AS lo
  FROM (SELECT id, piece, base, k, length(part) + CASE WHEN k > 1 THEN 1 ELSE 0 END AS n FROM (
    SELECT id, {owner} AS piece, {start} AS base, generate_subscripts(string_split(body, '{sep}'), 1) AS k,
           unnest(string_split(body, '{sep}')) AS part FROM {base}))) WHERE n > 0)"""

    def reach(f: str) -> str:
        return f"len(list_filter(cuts, lambda c: c <= cuts[{f}] + {size}))"

    following = (f"greatest(f, least(l, len(list_filter(cuts, lambda c: c < greatest(cuts[l] - {overlap}, "
                 f"cuts[l + 1] - {size}))) + 1))")
    return f"""whole AS (SELECT id, content AS body FROM {source} WHERE content <> ''),
{pieces('stops', 'whole', '-1', '0', '.')},
long_stops AS (SELECT s.id, s.lo, substr(w.body, CAST(s.lo + 1 AS BIGINT), CAST(s.n AS BIGINT)) AS body
               FROM stops s JOIN whole w USING (id) WHERE s.n >= {size}),
{pieces('words', 'long_stops', 'lo', 'lo', ' ')},
both_levels AS (SELECT * FROM stops UNION ALL SELECT * FROM words),
numbered AS (SELECT *, sum(CASE WHEN n >= {size} THEN 1 ELSE 0 END) OVER (PARTITION BY id, piece ORDER BY lo
             ROWS UNBOUNDED PRECEDING) AS run FROM both_levels),
runs AS (SELECT id, piece, run, list_append(list(CAST(lo AS BIGINT) ORDER BY lo), CAST(max(hi) AS BIGINT)) AS cuts
         FROM numbered WHERE n < {size} GROUP BY id, piece, run),
pack AS (
  SELECT id, cuts, CAST(1 AS BIGINT) AS f, {reach('1')} AS l FROM runs
  UNION ALL SELECT id, cuts, f, {reach('f')} FROM (SELECT id, cuts, {following} AS f FROM pack WHERE l < len(cuts))),
spans AS (
  SELECT id, cuts[f] AS lo, cuts[l] AS hi FROM pack
  UNION ALL SELECT id, lo + i * {step}, least(lo + i * {step} + {size}, hi) FROM (
    SELECT id, CAST(lo AS BIGINT) AS lo, CAST(hi AS BIGINT) AS hi,
           unnest(generate_series(0, CAST(greatest(ceil((n - {size}) / {step}.0), 0) AS BIGINT))) AS i
    FROM words WHERE n >= {size})),
cut AS (SELECT id, lo, trim(substr(w.body, lo + 1, hi - lo), ' ') AS chunk FROM spans JOIN whole w USING (id)),
chunks AS (SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY lo) - 1 AS INTEGER) AS chunk_index, chunk
           FROM cut WHERE chunk <> '')"""


ORACLES["chunk_text"] = with_(ART, CLEANED, chunking("cleaned")) + """
SELECT id AS doc_id, chunk_index, md5(chunk) AS chunk FROM chunks"""
LEAD = f"ltrim(chunk, {text(CHUNK_LEAD)})"
CHUNKED = f"""keyed AS (SELECT article_id AS id, content FROM loaded),
{chunking('keyed')},
parts AS (SELECT id AS article_id, chunk_index, {LEAD} AS content FROM chunks WHERE {LEAD} <> '')"""
CHUNK_STAR = with_(ART, META, DEDUP, LOADED, CHUNKED)
ORACLES["fact_chunks"] = CHUNK_STAR + """
SELECT CAST(article_id * 16777216 + chunk_index AS BIGINT) AS chunk_id, article_id, chunk_index, md5(content) AS content FROM parts"""
ORACLES["truncate_all"] = ORACLES["fact_articles"]
ORACLES["init_warehouse"] = CHUNK_STAR + " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n FROM {rows}" for name, rows in (
        ("dim_source", "src"), ("dim_time", "(SELECT 1 FROM tim UNION ALL SELECT 1)"), ("dim_content", "loaded"), ("dim_author", "aut"),
        ("fact_articles", "facts"), ("fact_article_authors", "bridge"), ("fact_chunks", "parts")))

# Vectors

VIEWED = """credits AS (SELECT article_id, string_agg(DISTINCT author_name, ', ' ORDER BY author_name) AS authors
            FROM written GROUP BY article_id),
viewed AS (SELECT p.article_id, p.chunk_index, p.content, l.title, l.url,
                  coalesce(strftime(l.d, '%Y-%m-%d'), 'Unknown') AS publish_date, coalesce(c.authors, 'Unknown') AS authors,
                  coalesce(CAST(epoch(l.d) AS BIGINT), 0) AS publish_timestamp, l.doc_id
           FROM parts p JOIN loaded l USING (article_id) LEFT JOIN credits c USING (article_id))"""
VIEW_STAR = with_(ART, META, DEDUP, LOADED, CHUNKED, VIEWED)
ORACLES["chunk_view"] = VIEW_STAR + """
SELECT article_id, chunk_index, md5(content) AS content, title, url, publish_date, authors FROM viewed"""
ORACLES["vec_2"] = with_(ART) + """
SELECT doc_id, coalesce(CAST(epoch(CAST(try_strptime(publish_date[1:10], '%Y-%m-%d') AS DATE)) AS BIGINT), 0)
       AS publish_timestamp FROM articles"""
ORACLES["point_id"] = f"""
SELECT l_orderkey, l_linenumber, {point_id('l_orderkey', 'l_linenumber')} AS id FROM lineitem"""
ORACLES["new_chunks"] = VIEW_STAR + f"""
SELECT {point_id('article_id', 'chunk_index')} AS id, article_id, chunk_index FROM viewed WHERE {UNSEEN}"""


def tokens(name: str, source: str, key: str, content: str) -> str:
    """CTE (key, token, id, n): distinct tokens of each text with their counts."""
    return f"""{name} AS (SELECT {key}, token, CAST('0x' || substr(sha256(token), 1, 7) AS INTEGER) AS id, count(*) AS n FROM (
  SELECT {key}, unnest(regexp_split_to_array(lower({content}), '[^\\p{{L}}\\p{{N}}]+')) AS token FROM {source})
  WHERE token <> '' GROUP BY {key}, token)"""


def cells(name: str, source: str, key: str) -> str:
    """CTE (key, cell, value): hashed unit vector from tokens, cells that are not zero."""
    return f"""{name}_sums AS (SELECT {key}, id % {DIM} AS cell, sum(CASE WHEN (id // {DIM}) % 2 = 0 THEN n ELSE -n END) AS s
  FROM {source} GROUP BY ALL),
{name} AS (SELECT {key}, cell, CAST(CAST(s AS DOUBLE) / sqrt(sum(s * s) OVER (PARTITION BY {key})) AS FLOAT) AS value
  FROM {name}_sums QUALIFY sum(s * s) OVER (PARTITION BY {key}) > 0)"""


DOC_TOKENS = tokens("doc_tokens", "articles", "doc_id", "content")
ORACLES["vec_5"] = with_(ART, DOC_TOKENS, cells("doc_cells", "doc_tokens", "doc_id")) + f"""
SELECT a.doc_id, CAST(g.cell AS INTEGER) AS cell, round(coalesce(CAST(c.value AS DOUBLE), 0), 5) AS value
FROM articles a CROSS JOIN generate_series(0, {DIM - 1}) AS g(cell) LEFT JOIN doc_cells c ON c.doc_id = a.doc_id AND c.cell = g.cell"""
ORACLES["vec_6"] = with_(ART, DOC_TOKENS) + "SELECT doc_id, token, round(1 + ln(n), 6) AS weight FROM doc_tokens"
ORACLES["vec_7"] = with_(ART, DOC_TOKENS) + """
SELECT doc_id, id AS token_id, round(CAST(CAST(max(1 + ln(n)) AS FLOAT) AS DOUBLE), 5) AS weight
FROM doc_tokens GROUP BY doc_id, id"""
ORACLES["vec_8"] = VIEW_STAR + f"""
SELECT {point_id('article_id', 'chunk_index')} AS id, article_id, chunk_index, title, url, md5(content) AS content, authors,
       publish_timestamp FROM viewed"""
ORACLES["init_points"] = VIEW_STAR + f"""
SELECT {point_id('article_id', 'chunk_index')} AS id, CAST({DIM} AS INTEGER) AS dim FROM viewed"""
NAMED_POINTS = with_(f"named AS (SELECT doc_id, {point_id('doc_id', '0')} AS id FROM documents)")
ORACLES["drop_points"] = NAMED_POINTS + "SELECT id, CAST(3 AS INTEGER) AS dim, 'new' AS title FROM named"
ORACLES["upsert_table"] = NAMED_POINTS + """
SELECT id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'new' ELSE 'old' END AS title FROM named
UNION ALL SELECT id || '-more', 'new' FROM named WHERE doc_id IN (SELECT doc_id FROM labels)"""
ORACLES["vectorize"] = with_(ART, META, DEDUP, LOADED, CHUNKED, VIEWED,
                             f"named AS (SELECT {point_id('article_id', 'chunk_index')} AS pid, content FROM viewed)",
                             tokens("point_tokens", "named", "pid", "content"),
                             cells("point_cells", "point_tokens", "pid")) + f"""
SELECT pid AS id, CAST({DIM} AS INTEGER) AS dim, CAST(coalesce(t.n, 0) AS INTEGER) AS tokens,
       round(coalesce(c.length, 0), 4) AS length, round(coalesce(c.checksum, 0), 3) + 0.0 AS checksum
FROM named LEFT JOIN (SELECT pid, count(DISTINCT id) AS n FROM point_tokens GROUP BY pid) t USING (pid)
LEFT JOIN (SELECT pid, sqrt(sum(CAST(value AS DOUBLE) * value)) AS length, sum(CAST(value AS DOUBLE) * (cell + 1)) AS checksum
           FROM point_cells GROUP BY pid) c USING (pid)"""

# Retrieval

ASKED = "asked AS (SELECT item_id AS query_id, text FROM benchmark)"
PREFIX = text(retrieval.QUERY_PREFIX + " ")
ORACLES["encode_queries"] = with_(
    ASKED, tokens("asked_tokens", "asked", "query_id", "text"),
    tokens("prefixed_tokens", "asked", "query_id", f"{PREFIX} || text"),
    cells("asked_cells", "prefixed_tokens", "query_id")) + f"""
SELECT a.query_id, CAST(t.n AS INTEGER) AS tokens, CAST(g.cell AS INTEGER) AS cell,
       round(coalesce(CAST(c.value AS DOUBLE), 0), 5) AS value
FROM asked a CROSS JOIN generate_series(0, {DIM - 1}) AS g(cell)
JOIN (SELECT query_id, count(DISTINCT id) AS n FROM asked_tokens GROUP BY query_id) t USING (query_id)
LEFT JOIN asked_cells c ON c.query_id = a.query_id AND c.cell = g.cell"""
CENTROIDS = """means AS (SELECT query_id, list(mean ORDER BY pos) AS vector FROM (
  SELECT query_id, pos, avg(x) AS mean FROM (
    SELECT CAST(label AS BIGINT) AS query_id, generate_subscripts(embedding, 1) AS pos,
           CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) GROUP BY query_id, pos) GROUP BY query_id)"""


def list_cosine(a: str, b: str) -> str:
    return f"list_dot_product({a}, {b}) / (sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b})))"


def ranked(source: str, k: int = retrieval.TOP_K) -> str:
    return f"""SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank
  FROM {source} QUALIFY rank <= {k}"""


SHOWN = "SELECT query_id, id, round(score, 6) + 0.0 AS score, rank FROM {}"
ORACLES["dense_topk"] = with_(CENTROIDS, f"""scored AS (
  SELECT query_id, vec_id AS id, round({list_cosine('vector', 'CAST(embedding AS DOUBLE[])')}, 12) AS score
  FROM means CROSS JOIN embeddings), best AS ({ranked('scored')})""") + SHOWN.format("best")
SEARCH = ",\n".join([
    ART, ASKED, DOC_TOKENS, cells("doc_cells", "doc_tokens", "doc_id"),
    tokens("asked_tokens", "asked", "query_id", "text"), cells("asked_cells", "asked_tokens", "query_id"), f"""
doc_weights AS (SELECT doc_id, id, max(1 + ln(n)) AS w FROM doc_tokens GROUP BY doc_id, id),
asked_weights AS (SELECT query_id, id, max(1 + ln(n)) AS w FROM asked_tokens GROUP BY query_id, id),
sparse_scores AS (SELECT query_id, doc_id AS id, round(sum(a.w * d.w), 12) AS score
                  FROM asked_weights a JOIN doc_weights d ON a.id = d.id GROUP BY query_id, doc_id),
sparse_top AS ({ranked('sparse_scores')}),
doc_norms AS (SELECT doc_id, sqrt(sum(CAST(value AS DOUBLE) * value)) AS len FROM doc_cells GROUP BY doc_id),
asked_norms AS (SELECT query_id, sqrt(sum(CAST(value AS DOUBLE) * value)) AS len FROM asked_cells GROUP BY query_id),
dots AS (SELECT query_id, doc_id, sum(CAST(a.value AS DOUBLE) * CAST(d.value AS DOUBLE)) AS dot
         FROM asked_cells a JOIN doc_cells d ON a.cell = d.cell GROUP BY query_id, doc_id),
dense_scores AS (SELECT a.query_id, d.doc_id AS id, round(coalesce(dot / (an.len * dn.len), 0), 12) + 0.0 AS score
  FROM asked a CROSS JOIN articles d LEFT JOIN dots s ON s.query_id = a.query_id AND s.doc_id = d.doc_id
  LEFT JOIN asked_norms an ON an.query_id = a.query_id LEFT JOIN doc_norms dn ON dn.doc_id = d.doc_id),
dense_top AS ({ranked('dense_scores')}),
sparse_unit AS (SELECT query_id, id, CASE WHEN max(score) OVER w = min(score) OVER w THEN score
  ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END AS s FROM sparse_top
  WINDOW w AS (PARTITION BY query_id)),
dense_unit AS (SELECT query_id, id, CASE WHEN max(score) OVER w = min(score) OVER w THEN score
  ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END AS d FROM dense_top
  WINDOW w AS (PARTITION BY query_id)),
fused AS (SELECT query_id, id, round(coalesce(s, 0.0) * 0.5 + coalesce(d, 0.0) * 0.5, 12) AS score
          FROM sparse_unit FULL JOIN dense_unit USING (query_id, id)),
hybrid AS ({ranked('fused')})"""])
ORACLES["sparse_topk"] = with_(SEARCH) + SHOWN.format("sparse_top")
ORACLES["hybrid_topk"] = with_(SEARCH) + SHOWN.format("hybrid")
ORACLES["ret_5"] = with_(SEARCH) + f"SELECT query_id, id, rank FROM hybrid WHERE rank <= {retrieval.RERANK_POOL}"


def overlap_hits(title: str, url: str) -> str:
    return f"""asked_words AS (SELECT DISTINCT query_id, token FROM asked_tokens),
pairs AS (SELECT query_id, id, score AS retrieval_score, rank AS retrieval_rank FROM hybrid WHERE rank <= {retrieval.RERANK_POOL}),
shares AS (SELECT p.query_id, p.id, count(t.token) / count(*) AS share FROM pairs p
  JOIN asked_words w ON w.query_id = p.query_id LEFT JOIN doc_tokens t ON t.doc_id = p.id AND t.token = w.token
  GROUP BY p.query_id, p.id),
rescored AS (SELECT p.*, share AS score FROM pairs p JOIN shares USING (query_id, id)),
reranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, retrieval_rank, id) AS INTEGER) AS rank
             FROM rescored),
hits AS (SELECT r.query_id, r.rank, CAST(r.id AS VARCHAR) AS id, coalesce(nullif({title}, ''), 'No Title') AS title,
                a.content, coalesce(nullif({url}, ''), '#') AS url, r.score, a.author
         FROM reranked r JOIN articles a ON a.doc_id = r.id)"""


RERANKED = overlap_hits("CASE WHEN a.doc_id % 3 <> 0 THEN a.title END", "CASE WHEN a.doc_id % 4 <> 0 THEN a.url END")
HITS = with_(SEARCH, RERANKED)
ORACLES["rerank"] = HITS + """
SELECT query_id, id, round(score, 6) AS score, rank, round(retrieval_score, 6) + 0.0 AS retrieval_score FROM reranked"""
ORACLES["ret_7"] = HITS + """
SELECT query_id, rank, id, title, md5(content) AS content, url, score, 'author' AS fields, author FROM hits"""
CONTEXTS = """contexts AS (SELECT query_id, string_agg('[' || rank || '] ' || title || ': ' || content || chr(10) || 'Source: ' || url,
  chr(10) || chr(10) ORDER BY rank) AS context FROM hits GROUP BY query_id)"""
ORACLES["format_context"] = with_(SEARCH, RERANKED, CONTEXTS) + "SELECT query_id, md5(context) AS context FROM contexts"
_before, _after = retrieval.HUMAN_TEMPLATE.split("{context}")
_middle, _end = _after.split("{question}")
PROMPT = f"md5({text(_before)} || context || {text(_middle)} || text || {text(_end)}) AS prompt"
ORACLES["build_prompts"] = with_(SEARCH, RERANKED, CONTEXTS) + f"""
SELECT query_id, {text(retrieval.SYSTEM_TEMPLATE)} AS system, {PROMPT} FROM contexts JOIN asked USING (query_id)"""
ORACLES["answer_records"] = HITS + f"""
SELECT a.query_id, a.text AS query, max(h.title) FILTER (WHERE h.rank = 1) AS summary,
       CAST(count(*) AS INTEGER) AS total, string_agg(h.id, ',' ORDER BY h.rank) AS ids
FROM asked a JOIN hits h USING (query_id) GROUP BY a.query_id, a.text
UNION ALL SELECT -page_id - 1, url, {text(retrieval.NO_SOURCES)}, 0, '' FROM pages"""
ORACLES["retrieve"] = with_(SEARCH, overlap_hits("a.title", "a.url"), CONTEXTS) + f"""
SELECT query_id, CAST(n AS INTEGER) AS hits, {PROMPT} FROM contexts JOIN asked USING (query_id)
JOIN (SELECT query_id, max(rank) AS n FROM hits GROUP BY query_id) USING (query_id)"""

# Evaluation

MODELS = "(VALUES ('model-a'), ('model-b')) AS m(model)"
ORACLES["eval_grid"] = f"SELECT model, item_id AS query_id FROM benchmark CROSS JOIN {MODELS}"
ORACLES["eval_records"] = HITS + f"""
SELECT model, a.query_id, {strip('a.text')} AS question, {strip('a.text')} AS ground_truth,
       CASE WHEN model = 'model-a' THEN coalesce(nullif(h.answer, ''), {text(NO_ANSWER)}) ELSE {text(NO_ANSWER)} END AS answer,
       CAST(coalesce(h.n, 0) AS INTEGER) AS n_contexts, md5(coalesce(h.contexts, '')) AS contexts
FROM asked a CROSS JOIN {MODELS} LEFT JOIN (
  SELECT query_id, count(*) AS n, string_agg(content, '|' ORDER BY rank) AS contexts,
         max(title) FILTER (WHERE rank = 1) AS answer FROM hits GROUP BY query_id) h USING (query_id)"""
ORACLES["context_precision"] = with_(VERDICTS, """running AS (
  SELECT *, sum(verdict) OVER (PARTITION BY query_id ORDER BY rank) AS hits FROM verdicts)""") + f"""
SELECT query_id, round(sum(CASE WHEN verdict = 1 THEN hits / rank ELSE 0 END) / (sum(verdict) + {EPSILON}), 6)
       AS context_precision FROM running GROUP BY query_id"""
ORACLES["context_recall"] = with_(VERDICTS) + """
SELECT query_id, round(avg(1 - toxic), 6) AS context_recall FROM verdicts GROUP BY query_id"""
ORACLES["answer_relevancy"] = with_(CENTROIDS) + f"""
SELECT query_id, round(CASE WHEN query_id % 4 = 3 THEN 0.0 ELSE avg({list_cosine('vector', 'CAST(embedding AS DOUBLE[])')}) END, 6)
       AS answer_relevancy FROM embeddings JOIN means ON query_id = label GROUP BY query_id"""
ORACLES["model_scoreboard"] = with_(VERDICTS, """scores AS (SELECT model, CASE WHEN toxic = 0 THEN CAST(verdict AS DOUBLE) END
  AS faithfulness, CASE WHEN rank <> 1 THEN n_chars / 1000 END AS answer_relevancy, verdict / rank AS context_precision,
  CAST(1 - toxic AS DOUBLE) AS context_recall FROM verdicts)""") + f"""
SELECT model, {', '.join(f'round(avg({m}), 6) AS {m}' for m in METRICS)} FROM scores GROUP BY model"""

# Reports

COUNTS = """counts AS (SELECT (SELECT count(*) FROM facts) AS articles, (SELECT count(*) FROM parts) AS chunks,
  (SELECT count(*) FROM meta WHERE publish_date = 'Unknown') AS unknown_dates)"""
ORACLES["warehouse_metrics"] = with_(ART, META, DEDUP, LOADED, CHUNKED, COUNTS) + """
SELECT *, CASE WHEN articles > 0 THEN round_even(chunks / articles, 2) ELSE 0 END AS chunks_per_article FROM counts"""
ORACLES["latest_articles"] = STAR + """
SELECT article_id, title, string_agg(author_name, ' & ' ORDER BY author_name) AS authors
FROM facts JOIN bridge USING (article_id) JOIN aut USING (author_id)
GROUP BY article_id, title ORDER BY article_id DESC LIMIT 20"""
ORACLES["latest_chunks"] = CHUNK_STAR + """
SELECT chunk_index, content FROM parts WHERE article_id = (SELECT max(article_id) FROM facts) ORDER BY chunk_index"""
ORACLES["articles_by_month"] = STAR + """
SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, count(*) AS n_articles
FROM loaded GROUP BY ALL ORDER BY year DESC, month DESC"""
ORACLES["bad_dates"] = with_(ART, META) + """
SELECT title, url FROM meta WHERE publish_date = 'Unknown' ORDER BY url_hash LIMIT 10"""
ORACLES["live_metrics"] = ORACLES["warehouse_metrics"]
