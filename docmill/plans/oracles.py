"""DuckDB statements for the catalog's queries, written against the rules and not against the Spark plans.

Each is (columns with types, statement); the types are those that Spark returns."""

from __future__ import annotations

from docmill.config import BOILERPLATE_SECTION, BOILERPLATE_SUBTREE, TEMPLATE_HEADING
from docmill.operators.bundle import EMBEDDING, SOURCE_IDS
from docmill.plans.markdown import DECORATION


def sub(x: str, pattern: str, to: str = "", flags: str = "g") -> str:
    return f"regexp_replace({x}, '{pattern}', '{to}', '{flags}')"


def strip(x: str) -> str:
    return sub(x, r"^\s+|\s+$")


def inline(x: str) -> str:
    x = sub(x, r"\[([^\]]+)\]\([^)]+\)", r"\1")
    return f"trim({sub(sub(sub(x, '<[^>]+>', ' '), '[*_`~]+'), r'\s+', ' ')})"


def key(x: str) -> str:
    return f"lower(trim({inline(x)}, ': '))"


def footer(x: str) -> str:
    p = f"lower({inline(f"replace({x}, '|', ' ')")})"
    return f"(starts_with({p}, 'revision no.') OR regexp_full_match({p}, 'page\\s+[ivxlcdm\\d]+\\s+of\\s+\\d+'))"


def artifact(x: str) -> str:
    s = strip(x)
    return f"({s} = '' OR regexp_full_match({s}, '\\|?[-:\\s|]+\\|?') OR (starts_with({s}, '|') AND ends_with({s}, '|') AND replace(replace({s}, '|', ''), ' ', '') = ''))"


def line_class(x: str) -> str:
    s = strip(x)
    return f"CASE WHEN {s} = '' THEN 'blank' WHEN starts_with({s}, '|') AND ends_with({s}, '|') THEN 'table' WHEN regexp_matches({x}, '^\\s*([-*+]\\s+|\\d+[.)]\\s+)') THEN 'list' ELSE 'paragraph' END"


def split_lines(frame: str, text: str = "text") -> str:
    """source, line_no, line of a frame's texts; a final line break makes no line."""
    return (
        f"SELECT source, CAST(i - 1 AS INT) AS line_no, line FROM (SELECT source, unnest(p) AS line, generate_subscripts(p, 1) AS i, len(p) AS n "
        f"FROM (SELECT source, string_split({text}, chr(10)) AS p FROM {frame})) WHERE NOT (i = n AND line = '')"
    )


_BEFORE = "(PARTITION BY source ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
DOCS = "docs AS (SELECT doc_id AS source, text FROM documents)"
MD = (
    "l0 AS (SELECT doc_id AS d, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS ln FROM documents), "
    "l1 AS (SELECT d, ln, (d * 7 + ln * 5) % 24 AS r, x FROM l0), "
    f"md AS (SELECT d AS source, string_agg({DECORATION}, chr(10) ORDER BY ln) AS text FROM l1 GROUP BY d)"
)
ML = MD + ", ml AS (" + split_lines("md", sub("text", "<span[^>]*></span>")) + ")"
PL = ML + (
    r", pm AS (SELECT *, try_cast(nullif(regexp_extract(line, '^\s*<!--\s*page:\s*(\d+)\s*-->', 1), '') AS INT) AS mark FROM ml), "
    f"pl AS (SELECT source, line_no, line, page FROM (SELECT *, coalesce(last_value(mark IGNORE NULLS) OVER {_BEFORE}, 1) AS page FROM pm) WHERE mark IS NULL)"
)


def headings(frame: str) -> str:
    s = strip("line")
    bold = r"regexp_extract(s, '^\*\*(.+?)\*\*$', 1)"
    like = f"({bold} <> '' AND {inline(bold)} <> '' AND length({inline(bold)}) <= 160 AND NOT regexp_matches({inline(bold)}, '[.;?!]$') AND len(string_split({inline(bold)}, ' ')) BETWEEN 3 AND 18)"
    atx = r"'^(#{1,6})\s+(.*\S)\s*$'"
    return (
        f"SELECT *, CAST(CASE WHEN regexp_matches(s, {atx}) THEN length(regexp_extract(s, {atx}, 1)) WHEN {like} THEN 3 END AS INT) AS level, "
        f"CASE WHEN regexp_matches(s, {atx}) THEN {inline(f'regexp_extract(s, {atx}, 2)')} WHEN {like} THEN {inline(bold)} END AS htext FROM (SELECT *, {s} AS s FROM {frame})"
    )


def _path(k: int) -> str:
    newer = "".join(f" AND o{k} > coalesce(o{j}, -1)" for j in range(1, k))
    return f"CASE WHEN o{k} IS NOT NULL AND level >= {k}{newer} THEN t{k} END"


_UPTO = "(PARTITION BY source ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
SECTIONS = (
    PL + f", hd AS ({headings('pl')}), od AS (SELECT *, sum(CASE WHEN level IS NULL THEN 0 ELSE 1 END) OVER {_BEFORE} AS ordinal FROM hd), "
    "sg AS (SELECT source, ordinal, max(level) AS level, max(CASE WHEN level IS NOT NULL THEN s END) AS raw, max(htext) AS htext, max(CASE WHEN level IS NOT NULL THEN page END) AS hpage, "
    "arg_min(page, line_no) FILTER (level IS NULL AND s <> '') AS p0, arg_max(page, line_no) FILTER (level IS NULL AND s <> '') AS p1, "
    f"{strip("coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (level IS NULL), '')")} AS body FROM od GROUP BY source, ordinal), "
    "sk AS (SELECT * FROM sg WHERE level IS NOT NULL OR p0 IS NOT NULL), sw AS (SELECT *, "
    + ", ".join(f"last_value(CASE WHEN level = {k} THEN ordinal END IGNORE NULLS) OVER {_UPTO} AS o{k}, last_value(CASE WHEN level = {k} THEN htext END IGNORE NULLS) OVER {_UPTO} AS t{k}" for k in range(1, 7))
    + " FROM sk), sc AS (SELECT source, CAST(row_number() OVER (PARTITION BY source ORDER BY ordinal) AS INT) AS section_no, ordinal, level, raw AS heading_raw, htext AS heading_text, "
    + "list_filter([" + ", ".join(_path(k) for k in range(1, 7)) + "], lambda h: h IS NOT NULL) AS path, coalesce(hpage, p0) AS page_start, coalesce(p1, hpage, p0) AS page_end, body FROM sw)"
)


def _reason() -> str:
    """Sections as CTEs, the last of which is ``why``: source, section_no, reason."""

    def any_of(x: str, parts: tuple[str, ...]) -> str:
        return f"regexp_matches({x}, '" + "|".join(parts) + "')"

    def cells(bare_first: bool) -> str:
        plain = f"list_transform(string_split(trim(t, '|'), '|'), lambda c: {strip(sub('c', '<[^>]+>'))})"
        kept = f"list_transform(string_split(trim(t, '|'), '|'), lambda c: {strip('c')})"
        return f"list_filter(list_transform({{}}, lambda t: {{{{'sep': len(list_filter({plain if bare_first else kept}, lambda c: NOT regexp_matches(c, '^[-: ]+$'))) = 0, 'n': len({plain}), 'f': len(list_filter({plain}, lambda c: c <> ''))}}}}), lambda r: NOT r.sep)"

    whole = "concat_ws(chr(10) || chr(10), heading_raw, nullif(body, ''))"
    filled = f"list_transform(list_filter(string_split(body, chr(10)), lambda t: {strip('t')} <> ''), lambda t: {sub('t', r'\s+$')})"
    tocish = f"regexp_matches({inline('t')}, '\\b\\d+\\s*$') OR (starts_with({strip('t')}, '|') AND regexp_matches(t, '\\|\\s*[\\divxlcdmIVXLCDM]+\\s*\\|\\s*$'))"
    rows = (
        f"rx AS (SELECT *, {whole} AS whole, {filled} AS fl FROM sc), "
        "ry AS (SELECT *, list_filter(fl, lambda t: starts_with(t, '|') AND ends_with(t, '|')) AS tb FROM rx), "
        f"rz AS (SELECT *, {cells(False).format('fl')} AS r5, {cells(True).format('tb')} AS r6, {inline('whole')} AS wp, list_filter(string_split(whole, chr(10)), lambda t: {strip('t')} <> '') AS wl FROM ry)"
    )
    case = (
        f"CASE WHEN {any_of(key("coalesce(heading_text, '')"), BOILERPLATE_SECTION)} THEN 'boilerplate' "
        f"WHEN len(list_filter(path[:-2], lambda h: {any_of(key('h'), BOILERPLATE_SUBTREE)})) > 0 THEN 'subtree' WHEN body = '' THEN 'empty' "
        f"WHEN regexp_matches({inline('body')}, '(?i)^\\s*Recommendations?\\s+[\\d.]+(?:\\s*(?:,|and|to|–|-)\\s*[\\d.]+)*\\.?\\s*$') THEN 'cross_reference' "
        "WHEN len(fl) > 0 AND len(fl) = len(tb) AND (len(r5) = 0 OR len(list_filter(r5, lambda r: r.f = 0)) / len(r5) > 0.5) THEN 'blank_form' "
        f"WHEN regexp_matches({key("CASE WHEN len(path) > 0 THEN array_to_string(path, ' ') ELSE coalesce(heading_text, '') END")}, '{TEMPLATE_HEADING}') AND len(tb) >= 3 AND len(tb) / len(fl) >= 0.7 "
        "AND (len(r6) = 0 OR (list_max(list_transform(r6, lambda r: r.n)) >= 5 AND list_sum(list_transform(r6, lambda r: r.f)) / list_sum(list_transform(r6, lambda r: r.n)) < 0.45)) THEN 'sparse_template' "
        f"WHEN len(regexp_extract_all(wp, '\\b[A-Z]-\\d+(?:[\\-–]\\d+)?\\b')) >= 5 AND ((heading_text <> '' AND heading_text = upper(heading_text) AND length(heading_text) <= 24) OR contains(lower(wp), 'see also')) THEN 'manual_index' "
        f"WHEN contains(lower(wp), 'table of contents') OR (len(wl) >= 5 AND len(list_filter(wl, lambda t: {tocish})) >= greatest(4, len(wl) // 2)) THEN 'contents_list' ELSE 'kept' END"
    )
    return f"{SECTIONS}, {rows}, why AS (SELECT source, section_no, {case} AS reason FROM rz)"


_SB = "(PARTITION BY source, section_no ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
BLOCKS = SECTIONS + (
    f", bl AS (SELECT source, section_no, line_no, line, od.page, {line_class('line')} AS class FROM od JOIN sc USING (source, ordinal) WHERE od.level IS NULL), "
    "bk AS (SELECT *, CASE WHEN class IN ('blank', 'table') THEN class ELSE 'text' END AS kind FROM bl), "
    "bs AS (SELECT *, CASE WHEN kind = lag(kind) OVER (PARTITION BY source, section_no ORDER BY line_no) THEN 0 ELSE 1 END AS step FROM bk), "
    f"bg AS (SELECT *, sum(step) OVER {_SB} AS seg FROM bs), "
    "bi AS (SELECT *, max(CASE WHEN class = 'list' THEN 1 ELSE 0 END) OVER (PARTITION BY source, section_no, seg ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS inlist FROM bg), "
    "bd AS (SELECT *, CAST(dense_rank() OVER (PARTITION BY source, section_no ORDER BY seg, inlist) AS INT) AS block FROM bi WHERE class <> 'blank'), "
    f"blocks AS (SELECT source, section_no, block, arg_min(class, line_no) AS block_type, {strip('string_agg(line, chr(10) ORDER BY line_no)')} AS text, arg_min(page, line_no) AS page_start, arg_max(page, line_no) AS page_end FROM bd GROUP BY ALL)"
)

def packing(units: str) -> str:
    """CTEs that end in ``gr`` (source, i, own): greedy groups of the frame ``units`` (source, i from 1, n: length, h: length before the first)."""
    flush = "f.k > 0 AND u.h + f.c + 2 + u.n > 800"
    c = f"CASE WHEN f.k = 0 OR {flush} THEN u.n ELSE f.c + 2 + u.n END"
    k = f"CASE WHEN f.k = 0 OR {flush} THEN 1 ELSE f.k + 1 END"
    g = f"f.g + CASE WHEN {flush} THEN 1 ELSE 0 END"
    alone = f"({k}) = 1 AND u.h + u.n >= 800"
    return (
        f"gr AS (SELECT DISTINCT source, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS own, CAST(0 AS BIGINT) AS g, CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS c FROM {units} "
        f"UNION ALL SELECT u.source, u.i, {g}, {g} + CASE WHEN {alone} THEN 1 ELSE 0 END, CASE WHEN {alone} THEN 0 ELSE {k} END, CASE WHEN {alone} THEN 0 ELSE {c} END FROM gr AS f JOIN {units} AS u ON u.source = f.source AND u.i = f.i + 1)"
    )


def packed() -> str:
    s = strip("line")
    return (
        f"WITH RECURSIVE {DOCS}, dl AS ({split_lines('docs')}), cells AS (SELECT source, line_no, {s} AS text FROM dl WHERE {s} <> ''), "
        f"u AS (SELECT source, text, length(text) AS n, 11 AS h, row_number() OVER (PARTITION BY source ORDER BY line_no) AS i FROM cells), {packing('u')} "
        "SELECT source, own AS group_no, count(*) AS n_blocks, string_agg(text, chr(10) || chr(10) ORDER BY u.i) AS body FROM gr JOIN u USING (source, i) GROUP BY source, own"
    )


def cutting(frame: str) -> str:
    """CTEs that end in ``pc`` (source, piece_no, piece): windows of the frame's (source, text, size), which overlap by 100."""

    def last(separator: str, a: str) -> str:
        """Length of the window at ``a`` up to and including the last separator that begins at or after the overlap, else 0."""
        inner = f"substr(text, {a} + 101, size - 100)"
        return f"CASE WHEN contains({inner}, {separator}) THEN size - strpos(reverse({inner}), reverse({separator})) + 1 ELSE 0 END"

    def end(a: str) -> str:
        kinds = ["chr(10) || chr(10)", "chr(10)", "'. '", "' '"]
        return f"CASE WHEN {a} + size >= length(text) THEN -1 ELSE {a} + coalesce(" + ", ".join(f"nullif({last(kind, a)}, 0)" for kind in kinds) + ", size) END"

    return (
        f"wz AS (SELECT source, text, size, CAST(0 AS BIGINT) AS a, CAST({end('0')} AS BIGINT) AS b, 0 AS k, length(text) <= size AS whole FROM {frame} "
        f"UNION ALL SELECT source, text, size, a2, CAST({end('a2')} AS BIGINT), k + 1, false FROM (SELECT *, greatest(a + 1, b - 100) AS a2 FROM wz WHERE b <> -1)), "
        f"wp AS (SELECT source, k, whole, CASE WHEN whole THEN text WHEN b = -1 THEN {strip('substr(text, a + 1)')} ELSE {strip('substr(text, a + 1, b - a)')} END AS piece FROM wz), "
        "pc AS (SELECT source, CAST(row_number() OVER (PARTITION BY source ORDER BY k) - 1 AS INT) AS piece_no, piece FROM wp WHERE whole OR piece <> '')"
    )


def windows() -> str:
    return f"WITH RECURSIVE {DOCS}, sized AS (SELECT source, text, 800 AS size FROM docs), {cutting('sized')} SELECT * FROM pc"


def greedy_pieces(kind: str) -> str:
    """Row or item groups of the long tables or lists."""
    long = f"lb AS (SELECT * FROM blocks WHERE block_type = '{kind}' AND length(text) > 800), ln AS (SELECT bd.* FROM bd JOIN lb USING (source, section_no, block))"
    own = "PARTITION BY source, section_no, block"
    if kind == "table":
        units = (
            f"nr AS (SELECT *, row_number() OVER ({own} ORDER BY line_no) AS i, count(*) OVER ({own}) AS n FROM ln), hh AS (SELECT source, section_no, block, string_agg(line, chr(10) ORDER BY line_no) AS head FROM nr WHERE i <= 2 AND n > 2 GROUP BY ALL), "
            "u AS (SELECT source, section_no, block, i - 2 AS i, line AS t, head FROM nr JOIN hh USING (source, section_no, block) WHERE i > 2)"
        )
        short = " UNION ALL SELECT source, section_no, block, 0, any_value(lb.text) FROM lb JOIN ln USING (source, section_no, block) GROUP BY ALL HAVING count(*) < 3"
        whole = "length(u.head || chr(10) || {})"
        made = "arg_min(head, i) || chr(10) || string_agg(t, chr(10) ORDER BY i)"
    else:
        units = (
            f"nr AS (SELECT *, sum(CASE WHEN class = 'list' THEN 1 ELSE 0 END) OVER ({own} ORDER BY line_no) AS item FROM ln), it AS (SELECT source, section_no, block, item, string_agg(line, chr(10) ORDER BY line_no) AS t FROM nr GROUP BY ALL), "
            f"u AS (SELECT source, section_no, block, row_number() OVER ({own} ORDER BY item) AS i, t FROM it)"
        )
        short = ""
        whole = f"length({strip('{}')})"
        made = strip("string_agg(t, chr(10) ORDER BY i)")
    fits = f"f.i > 0 AND {whole.format('f.held || chr(10) || u.t')} <= 800"
    return (
        f"WITH RECURSIVE {BLOCKS}, {long}, {units}, f AS (SELECT DISTINCT source, section_no, block, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS g, '' AS held FROM u "
        f"UNION ALL SELECT u.source, u.section_no, u.block, u.i, CASE WHEN f.i = 0 OR {fits} THEN f.g ELSE f.g + 1 END, CASE WHEN {fits} THEN f.held || chr(10) || u.t ELSE u.t END "
        "FROM f JOIN u ON u.source = f.source AND u.section_no = f.section_no AND u.block = f.block AND u.i = f.i + 1) "
        f"SELECT source, section_no, block, CAST(g AS INT) AS piece_no, {made} AS piece FROM f JOIN u USING (source, section_no, block, i) WHERE i > 0 GROUP BY source, section_no, block, g{short}"
    )


def cleaning(frame: str) -> str:
    """CTEs that end in ``cd`` (source, cleaned) of the frame's (source, text)."""
    t = sub("text", "<sup[^>]*>.*?</sup>", "", "gis")
    t = sub(sub(sub(t, r"<br\s*/?>", " ", "gi"), "<[^>]+>"), r"\[([^\]]+)\]\(#[^)]*\)", r"\1")
    last = "(PARTITION BY source ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    joined = sub("coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT gone), '')", r"\n{3,}", "' || chr(10) || chr(10) || '")
    return (
        f"ct AS (SELECT source, {t} AS text FROM {frame}), cl AS ({split_lines('ct')}), fa AS (SELECT *, {footer('line')} AS f, {artifact('line')} AS e FROM cl), "
        f"rs AS (SELECT *, last_value(CASE WHEN f THEN 1 WHEN NOT e THEN 0 END IGNORE NULLS) OVER {last} AS st FROM fa), gn AS (SELECT *, f OR (e AND coalesce(st, 0) = 1) AS gone FROM rs), "
        f"cd AS (SELECT source, {sub(strip(joined), '[ \\t]{2,}', ' ')} AS cleaned FROM {frame} LEFT JOIN gn USING (source) GROUP BY source)"
    )


def passages() -> str:
    """CTEs that end in ``ch``: all passages, numbered.

    ``ks`` are the kept sections, ``lp`` the pieces of the long ones' blocks, ``bo`` the bodies, ``em`` passages before cleaning."""
    head = "concat_ws(chr(10) || chr(10), CASE WHEN len(path) > 1 THEN '> ' || array_to_string(path[:-2], ' > ') END, heading_raw)"
    return (
        f"{_reason()}, ks AS (SELECT *, source || ':' || section_no AS sid, length({strip("concat_ws(chr(10) || chr(10), heading_raw, nullif(body, ''))")}) > 1500 AS long FROM sc JOIN why USING (source, section_no) WHERE reason = 'kept'), "
        f"{BLOCKS.removeprefix(SECTIONS + ', ')}, tp AS ({greedy_pieces('table')}), ip AS ({greedy_pieces('list')}), "
        "kb AS (SELECT blocks.*, ks.sid, ks.heading_raw FROM blocks JOIN ks USING (source, section_no) WHERE ks.long), "
        "pg AS (SELECT sid || ':' || block AS source, text, 800 AS size FROM kb WHERE block_type = 'paragraph' OR length(text) <= 800), "
        f"pw AS (WITH RECURSIVE {cutting('pg')} SELECT * FROM pc), "
        "pq AS (SELECT source, section_no, block, piece_no, piece FROM tp UNION ALL SELECT source, section_no, block, piece_no, piece FROM ip "
        "UNION ALL SELECT kb.source, section_no, block, piece_no, piece FROM pw JOIN kb ON pw.source = sid || ':' || block), "
        f"lp AS (SELECT sid AS source, block_type, page_start, page_end, {strip('piece')} AS text, coalesce(length(heading_raw) + 2, 0) AS h, length({strip('piece')}) AS n, "
        f"row_number() OVER (PARTITION BY sid ORDER BY block, piece_no) AS i FROM pq JOIN kb USING (source, section_no, block) WHERE {strip('piece')} <> ''), {packing('lp')}, "
        "gb AS (SELECT source AS sid, own AS part_no, CASE WHEN count(DISTINCT block_type) = 1 THEN max(block_type) ELSE 'mixed' END AS type, arg_min(page_start, i) AS page_start, "
        "arg_max(page_end, i) AS page_end, string_agg(text, chr(10) || chr(10) ORDER BY i) AS body FROM gr JOIN lp USING (source, i) GROUP BY source, own), "
        "bo AS (SELECT sid, 0 AS part_no, 'section' AS type, page_start, page_end, body FROM ks WHERE NOT long UNION ALL SELECT * FROM gb), "
        f"hd2 AS (SELECT *, CASE WHEN length(h0) > 1698 THEN substr(h0, 1, 1697) || '…' ELSE h0 END AS head FROM (SELECT sid, source, section_no, path, {head} AS h0 FROM ks)), "
        f"bh AS (SELECT hd2.source AS src, section_no, path, head, part_no, type, page_start, page_end, sid || ':' || part_no AS source, {strip('body')} AS text, "
        "2500 - CASE WHEN head <> '' THEN length(head) + 2 ELSE 0 END AS size FROM bo JOIN hd2 USING (sid)), "
        f"bw AS (WITH RECURSIVE {cutting('bh')} SELECT * FROM pc), "
        f"em AS (SELECT bh.* EXCLUDE (source, text, size), piece_no, bh.source || ':' || piece_no AS source, concat_ws(chr(10) || chr(10), nullif(head, ''), {strip('piece')}) AS text FROM bw JOIN bh USING (source) WHERE {strip('piece')} <> ''), "
        f"{cleaning('em')}, "
        "ch AS (SELECT row_number() OVER (ORDER BY src, section_no, part_no, piece_no) AS index, src AS source, src || ':section:' || lpad(CAST(section_no AS STRING), CAST(greatest(4, length(CAST(section_no AS STRING))) AS INT), '0') AS section_id, "
        "array_to_string(path, ' / ') AS section_path, type AS chunk_type, page_start, page_end, cleaned AS text FROM em JOIN cd USING (source) WHERE length(cleaned) >= 80), "
        "cn AS (SELECT *, source || ':chunk:' || lpad(CAST(index AS STRING), CAST(greatest(5, length(CAST(index AS STRING))) AS INT), '0') AS chunk_id FROM ch)"
    )


def html() -> str:
    h = "html"
    for tag in ("script", "style", "nav", "footer"):
        h = sub(h, f"(?is)<{tag}[^>]*>.*?</{tag}>")
    line = "' || chr(10) || '"
    h = sub(sub(sub(sub(h, "(?s)<!--.*?-->"), "(?i)<h1[^>]*>", line + "# "), "(?i)<li[^>]*>", line + "- "), r"(?i)<(?:p|/p|/h1|/li|br)\s*/?[^>]*>", line)
    return f"SELECT page_id AS source, {sub(sub(h, '<[^>]+>'), '[ \\t]+', ' ')} AS text FROM pages"


NORM = "trim(regexp_replace(regexp_replace({}, '[^A-Za-z0-9\\-.]', '_', 'g'), '_+', '_', 'g'), '_')"
ENTRY = f"{DOCS}, en AS (SELECT source, '<sep>[SOURCE:src' || (source % 20) || '|PAGE:1]' || chr(10) || replace(text, chr(10), CASE WHEN source % 5 = 0 THEN chr(10) || '<sep>' ELSE chr(10) END) AS file FROM docs)"
RECORDS = (
    ENTRY + f", rc AS (SELECT source, i, e FROM (SELECT source, unnest(p) AS e, generate_subscripts(p, 1) AS i FROM (SELECT source, string_split(chr(10) || file, chr(10) || '<sep>') AS p FROM en))), "
    f"re AS (SELECT source, CAST(row_number() OVER (PARTITION BY source ORDER BY i) - 1 AS INT) AS record_no, {strip('e')} AS entry FROM rc WHERE {strip('e')} <> '')"
)
INDEXED = f"WITH {DOCS}, dl AS ({split_lines('docs')}), nx AS (SELECT source, line_no, line, row_number() OVER (ORDER BY source, line_no) AS row_id FROM dl)"
_ENTRY_ROW = "source_id string, normalized_id string, bundle_path string, file_size bigint, sha256 string"
_MANIFEST = f"SELECT url AS source_id, {NORM.format('url')} AS normalized_id, 'docs/' || {NORM.format('url')} || '.pdf' AS bundle_path, strlen(html) AS file_size, sha256(html) AS sha256 FROM pages"
_COS = "SELECT q.vec_id AS query_id, r.vec_id, round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(r.embedding AS DOUBLE[])), 5) AS score FROM embeddings q JOIN embeddings r ON q.vec_id % 20 = 0 AND q.vec_id <> r.vec_id"

def _struct(values: dict) -> str:
    """A DuckDB struct of a dictionary of texts and numbers."""

    def literal(v) -> str:
        return str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"

    return "{" + ", ".join(f"'{k}': {literal(v)}" for k, v in values.items()) + "}"


_TURNS = "turns AS (SELECT conv_id, turn, regexp_matches(text, '\\S') AS words FROM conversations UNION ALL SELECT conv_id, -turn - 1, false FROM conversations WHERE turn % 10 = 0)"
WORD_SUMS = (
    f"{DOCS}, wd AS (SELECT source, unnest(regexp_extract_all(lower(text), '\\S+')) AS w FROM docs), hs AS (SELECT source, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) AS h FROM wd), "
    "sums AS (SELECT source, h % 768 AS b, sum(CASE WHEN h >= 2147483648 THEN 1 ELSE -1 END) AS x FROM hs GROUP BY ALL)"
)

RAW = {
    "q_lines": ("source bigint, line_no int, line string", f"WITH {DOCS} {split_lines('docs')}"),
    "q_page_fill": ("source bigint, line_no int, line string, page int", f"WITH {PL} SELECT * FROM pl"),
    "q_heading_detect": ("source bigint, line_no int, level int, raw string, heading_text string", f"WITH {ML}, hd AS ({headings('ml')}) SELECT source, line_no, level, s AS raw, htext AS heading_text FROM hd WHERE level IS NOT NULL"),
    "q_heading_path": ("source bigint, section_no int, path string, breadcrumb string", f"WITH {SECTIONS} SELECT source, section_no, array_to_string(path, ' / ') AS path, CASE WHEN len(path) > 1 THEN '> ' || array_to_string(path[:-2], ' > ') END AS breadcrumb FROM sc"),
    "q_sections": ("source bigint, section_no int, section_id string, level int, heading_raw string, heading_text string, page_start int, page_end int, body string", f"WITH {SECTIONS} SELECT *, source || ':section:' || lpad(CAST(section_no AS STRING), CAST(greatest(4, length(CAST(section_no AS STRING))) AS INT), '0') AS section_id FROM sc"),
    "q_classify_lines": ("source bigint, line_no int, class string", f"WITH {ML} SELECT source, line_no, {line_class('line')} AS class FROM ml"),
    "q_blocks": ("source bigint, section_no int, block int, block_type string, text string, page_start int, page_end int", f"WITH {BLOCKS} SELECT * FROM blocks"),
    "q_skip_reasons": ("source bigint, section_no int, reason string", f"WITH {_reason()} SELECT * FROM why"),
    "q_strip_spans": ("source bigint, stripped string, n_spans bigint", f"WITH {MD} SELECT source, {sub('text', '<span[^>]*></span>')} AS stripped, len(regexp_extract_all(text, '<span[^>]*></span>')) AS n_spans FROM md"),
    "q_span_totals": ("files bigint, unchanged bigint, removed bigint", f"WITH {MD}, n AS (SELECT len(regexp_extract_all(text, '<span[^>]*></span>')) AS n FROM md) SELECT count(*) AS files, count(*) FILTER (n = 0) AS unchanged, sum(n) AS removed FROM n"),
    "q_page_markers": ("source bigint, line_no int, part int, line string", f"WITH {DOCS}, dl AS ({split_lines('docs')}) SELECT source, line_no, unnest([0, 1, 2]) AS part, unnest([line, '<!-- page: ' || (line_no + 1) || ' -->', '{{7}}' || repeat('-', 47)]) AS line FROM dl"),
    "q_inline_strip": ("source bigint, line_no int, plain string, key string", f"WITH {ML} SELECT source, line_no, {inline('line')} AS plain, {key('line')} AS key FROM ml"),
    "q_footer_strip": ("source bigint, line_no int, footer boolean, artifact boolean", f"WITH {ML} SELECT source, line_no, {footer('line')} AS footer, {artifact('line')} AS artifact FROM ml"),
    "q_clean_text": ("source bigint, cleaned string", f"WITH {MD}, {cleaning('md')} SELECT * FROM cd"),
    "q_window_split": ("source bigint, piece_no int, piece string", windows()),
    "q_pack_blocks": ("source bigint, group_no int, n_blocks int, body string", packed()),
    "q_table_split": ("source bigint, section_no int, block int, piece_no int, piece string", greedy_pieces("table")),
    "q_list_split": ("source bigint, section_no int, block int, piece_no int, piece string", greedy_pieces("list")),
    "q_header_cap": ("source bigint, header string", f"WITH {DOCS}, h AS (SELECT source, '> Part > ' || text || chr(10) || chr(10) || '# ' || text AS h FROM docs) SELECT source, CASE WHEN length(h) > 1698 THEN substr(h, 1, 1697) || '…' ELSE h END AS header FROM h"),
    "q_dedup_first": ("doc_id bigint, n_chars int", "SELECT min(doc_id) AS doc_id, length(text) AS n_chars FROM documents GROUP BY text"),
    "q_dup_count": ("n_rows bigint, n_texts bigint, n_removed bigint", "SELECT count(*) AS n_rows, count(DISTINCT text) AS n_texts, count(*) - count(DISTINCT text) AS n_removed FROM documents"),
    "q_chunk_summary": ("n_chunks bigint, total_chars bigint, avg_chars bigint", f"SELECT count(*) AS n_chunks, sum(length(piece)) AS total_chars, sum(length(piece)) // count(*) AS avg_chars FROM ({windows()})"),
    "q_chunks_per_source": ("source bigint, n_chunks bigint", f"SELECT doc_id AS source, coalesce(n, 0) AS n_chunks FROM documents LEFT JOIN (SELECT source AS src, count(*) AS n FROM ({windows()}) GROUP BY source) ON src = doc_id"),
    "q_global_index": ("source bigint, line_no int, row_id bigint", f"{INDEXED} SELECT source, line_no, row_id FROM nx"),
    "q_slice": ("row_id bigint, line string", f"{INDEXED} SELECT row_id, line FROM nx WHERE row_id BETWEEN 101 AND 300"),
    "q_normalize_ids": ("page_id bigint, normalized_id string", f"SELECT page_id, {NORM.format('url')} AS normalized_id FROM pages"),
    "q_norm_collisions": ("normalized_id string, n bigint", f"SELECT {NORM.format('s')} AS normalized_id, count(DISTINCT s) AS n FROM (SELECT url AS s FROM pages UNION ALL SELECT replace(url, '/', '_') FROM pages) GROUP BY 1 HAVING count(DISTINCT s) > 1"),
    "q_exclude_anti": ("doc_id bigint, source string", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)"),
    "q_unresolved_sources": ("source bigint", "SELECT doc_id AS source FROM documents ANTI JOIN labels USING (doc_id)"),
    "q_resolve_first": ("source bigint, rel_path string", "SELECT doc_id AS source, min(quality || '/' || toxic) AS rel_path FROM documents LEFT JOIN labels USING (doc_id) GROUP BY doc_id"),
    "q_sha256": ("doc_id bigint, sha256 string, file_size bigint", "SELECT doc_id, sha256(text) AS sha256, strlen(text) AS file_size FROM documents"),
    "q_manifest": (_ENTRY_ROW, _MANIFEST),
    "q_checksums": ("line string", f"SELECT sha256 || '  ' || bundle_path AS line FROM ({_MANIFEST})"),
    "q_bad_entries": ("page_id bigint, path string", "SELECT page_id, [concat('x/._', url), concat('__MACOSX/', url), concat(url, '/.DS_Store'), url][page_id % 4 + 1] AS path FROM pages WHERE page_id % 4 < 3 OR regexp_matches(url, '(^|/)\\._|(^|/)\\.DS_Store$|^__MACOSX/')"),
    "q_bundle_totals": ("n_documents bigint, bytes bigint", "SELECT count(*) AS n_documents, sum(strlen(html)) AS bytes FROM pages"),
    "q_chunkfile_roundtrip": ("source bigint, record_no int, entry string", f"WITH {RECORDS} SELECT * FROM re"),
    "q_count_separators": ("source bigint, n bigint", f"WITH {ENTRY} SELECT source, len(regexp_extract_all(chr(10) || file, '\\n<sep>')) AS n FROM en"),
    "q_source_ids": ("source string", f"WITH {RECORDS} SELECT DISTINCT regexp_extract(entry, '^\\[SOURCE:([^|]+)\\|', 1) AS source FROM re WHERE starts_with(entry, '[SOURCE:')"),
    "q_labels": ("label string, n bigint", f"WITH {RECORDS} SELECT regexp_extract(entry, '^\\[(SOURCE:[^\\]]*)\\]', 1) AS label, count(*) AS n FROM re GROUP BY 1"),
    "q_union_corpora": (
        "corpus_rank int, n bigint, chars bigint, state string",
        "WITH u AS (SELECT 0 AS corpus_rank, CAST(doc_id AS STRING) AS source, text FROM documents UNION ALL SELECT 1, CAST(page_id AS STRING), html FROM pages) SELECT corpus_rank, count(*) AS n, sum(length(text)) AS chars, 'kept' AS state "
        "FROM u WHERE source NOT IN ('3', '5') GROUP BY 1 UNION ALL SELECT -1, count(*), 0, 'duplicate' FROM u WHERE source IN ('3', '5')",
    ),
    "q_progress": (
        "worker bigint, done int, total int, eta string, label string",
        "SELECT conv_id AS worker, max(turn) AS done, arg_max(length(text), turn) AS total, '00:' || lpad(CAST(max(turn) AS STRING), 2, '0') AS eta, 'part ' || arg_max(role, turn) AS label FROM conversations GROUP BY conv_id",
    ),
    "q_embed_stub": (
        "source bigint, dim int, n_bytes bigint, n_filled int, peak bigint, error string",
        f"WITH {WORD_SUMS}, st AS (SELECT source, count(*) FILTER (x <> 0) AS n, count(*) AS k, arg_max(b + 1, x * 768 - b) AS top, max(x) AS most FROM sums GROUP BY source), "
        # Where all are negative, the first empty place has the greatest value.
        "zero AS (SELECT source, min(b) + 1 AS b FROM (SELECT source, unnest(range(768)) AS b FROM st WHERE most <= 0) LEFT JOIN sums USING (source, b) WHERE coalesce(x, 0) = 0 GROUP BY source) "
        "SELECT doc_id AS source, coalesce(n * 0 + 768, -1) AS dim, n * 0 + 3076 AS n_bytes, coalesce(n, -1) AS n_filled, CASE WHEN most > 0 THEN top ELSE coalesce(zero.b, top) END AS peak, CASE WHEN n IS NULL THEN 'no words' END AS error "
        "FROM documents LEFT JOIN st ON st.source = doc_id LEFT JOIN zero ON zero.source = doc_id",
    ),
    "q_embed_counts": ("n_rows bigint, n_embedded bigint, n_errors bigint", f"WITH {_TURNS} SELECT count(*) AS n_rows, count(*) FILTER (words) AS n_embedded, count(*) FILTER (NOT words) AS n_errors FROM turns"),
    "q_embed_errors": ("conv_id bigint, turn bigint, error string", f"WITH {_TURNS} SELECT conv_id, turn, 'no words' AS error FROM turns WHERE NOT words"),
    "q_manifest_json": (
        "manifest string",
        f"WITH f AS (SELECT lpad(CAST(doc_id AS STRING), 12, '0') AS source, text FROM documents), d AS (SELECT source AS source_id, {NORM.format('source')} AS normalized_id, 'docs/' || {NORM.format('source')} || '.pdf' AS bundle_path, "
        "strlen(text) AS file_size, sha256(text) AS sha256 FROM f), listed AS (SELECT list(d ORDER BY source_id) AS documents FROM d), a AS (SELECT n_nationkey AS position, {'path': n_name, 'file_size': strlen(n_name), 'sha256': sha256(n_name)} AS a FROM nation) "
        "SELECT to_json({'schema_version': 1, 'bundle_version': 'v1', 'producer_repo': '', 'producer_commit': 'unknown', 'chunk_count': NULL, 'source_count': len(documents), "
        f"'embedding': {_struct(EMBEDDING)}, 'source_id_contract': {_struct(SOURCE_IDS)}, "
        "'artifacts': (SELECT list(a ORDER BY position) FROM a), 'documents': documents}) AS manifest FROM listed",
    ),
    "q_vf32_roundtrip": ("vec_id bigint, n_bytes bigint, prefix string, dim bigint, total double", "SELECT vec_id, 4 + 4 * len(embedding) AS n_bytes, '56463332' AS prefix, len(embedding) AS dim, round(list_sum(CAST(embedding AS DOUBLE[])), 4) AS total FROM embeddings"),
    "q_token_pad": ("source bigint, ids string", "SELECT doc_id AS source, array_to_string((list_transform(string_split(text, ' '), lambda w: length(w)) || list_transform(range(1024), lambda z: 0))[:1024], ' ') AS ids FROM documents"),
    "q_cosine_topk": ("query_id bigint, vec_id bigint, score double, rank int", f"SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM ({_COS}) QUALIFY rank <= 5"),
    "q_html_lines": (
        "source bigint, n_lines bigint, n_headings bigint, n_list bigint, n_chars bigint",
        f"WITH hm AS ({html()}), hl AS ({split_lines('hm')}), hd AS ({headings('hl')}) SELECT source, count(*) AS n_lines, count(level) AS n_headings, count(*) FILTER ({line_class('line')} = 'list') AS n_list, "
        f"sum(length({inline('line')})) AS n_chars FROM hd WHERE s <> '' GROUP BY source",
    ),
    "q_chunks_full": ("index bigint, chunk_id string, source bigint, section_id string, section_path string, chunk_type string, page_start int, page_end int, text string", f"WITH RECURSIVE {passages()} SELECT * FROM cn"),
    "q_chunks_dedup": (
        "index bigint, chunk_id string, source bigint, entry string, label string",
        f"WITH RECURSIVE {passages()}, lb2 AS (SELECT *, 'SOURCE:' || source || '|PAGE:' || page_start AS label FROM cn QUALIFY row_number() OVER (PARTITION BY text ORDER BY index) = 1) SELECT *, '[' || label || ']' || chr(10) || text AS entry FROM lb2",
    ),
    "q_chunks_total": ("n_chunks bigint, total_chars bigint, avg_chars bigint", f"WITH RECURSIVE {passages()} SELECT count(*) AS n_chunks, sum(length(text)) AS total_chars, sum(length(text)) // count(*) AS avg_chars FROM cn"),
    "q_events_windows": ("start bigint, event_type string, n bigint", "SELECT epoch(date_trunc('hour', ts)) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2"),
}


def typed(columns: str, statement: str) -> str:
    return "SELECT " + ", ".join(f"CAST({c.split()[0]} AS {c.split()[1]}) AS {c.split()[0]}" for c in columns.split(", ")) + f" FROM ({statement})"


SQL = {name: typed(*x) for name, x in RAW.items()}
