"""A sequential statement of the passage builder's rules, for comparison on small inputs."""

import re

from docmill.config import BOILERPLATE_SECTION, BOILERPLATE_SUBTREE, TEMPLATE_HEADING

SF = "/root/testdata/sf0.001"


def windows(text, size, overlap):
    """Every window's end is the greatest position, of the first kind that has one, where a whole break of that kind ends beyond the overlap."""
    out, a = [], 0
    while len(text) - a > size and len(text) > size:
        ends = [[e for e in range(a + overlap + len(k), a + size + 1) if text[e - len(k) : e] == k] for k in ("\n\n", "\n", ". ", " ")]
        b = next((max(e) for e in ends if e), a + size)
        out.append(text[a:b].strip())
        a = max(a + 1, b - overlap)
    return [p for p in [*out, text[a:].strip()] if p] if len(text) > size else [text]


def plain(t):
    t = re.sub(r"<[^>]+>", " ", re.sub(r"\[([^\]]+)\]\([^)]+\)", r"\1", t))
    return " ".join(re.sub(r"[*_`~]+", "", t).split())


def klass(line):
    s = line.strip()
    if not s:
        return "blank"
    if s[0] == s[-1] == "|":
        return "table"
    return "list" if re.match(r"\s*([-*+]\s+|\d+[.)]\s+)", line) else "paragraph"


def head_of(line):
    s = line.strip()
    if m := re.fullmatch(r"(#{1,6})\s+(.*\S)", s):
        return len(m[1]), s, plain(m[2])
    if (m := re.fullmatch(r"\*\*(.+?)\*\*", s)) and (t := plain(m[1])) and len(t) <= 160 and t[-1] not in ".;?!" and 3 <= len(t.split()) <= 18:
        return 3, s, t
    return None


def sections(text):
    page, out, stack = 1, [], []
    for line in re.sub(r"<span[^>]*></span>", "", text).splitlines():
        if m := re.match(r"<!--\s*page:\s*(\d+)\s*-->", line.strip()):
            page = int(m[1])
        elif h := head_of(line):
            stack = [x for x in stack if x[0] < h[0]] + [h]
            out.append({"head": h, "path": [x[2] for x in stack], "lines": [], "page": page})
        else:
            if not out:
                out.append({"head": None, "path": [], "lines": [], "page": None})
            out[-1]["lines"].append((line, page))
    found = []
    for s in out:
        filled = [p for t, p in s["lines"] if t.strip()]
        if s["head"] or filled:
            s["page"] = s["page"] if s["page"] is not None else filled[0]
            found.append(s | {"end": filled[-1] if filled else s["page"], "body": "\n".join(t for t, _ in s["lines"]).strip()})
    return found


def table_rows(lines, early):
    for line in lines:
        cells = [c.strip() for c in line.strip("|").split("|")]
        bare = [re.sub("<[^>]+>", "", c).strip() for c in cells]
        if not all(re.fullmatch("[-: ]+", c) for c in (bare if early else cells)):
            yield bare


def dropped(s):
    key = lambda t: plain(t).strip(": ").lower()
    head, body = s["head"][2] if s["head"] else "", s["body"]
    if head and any(p in key(head) for p in BOILERPLATE_SECTION):
        return "boilerplate"
    if any(p in key(h) for h in s["path"][:-1] for p in BOILERPLATE_SUBTREE):
        return "subtree"
    if not body:
        return "empty"
    if re.match(r"(?i)\s*Recommendations?\s+[\d.]+(?:\s*(?:,|and|to|–|-)\s*[\d.]+)*\.?\s*$", plain(body)):
        return "cross_reference"
    lines = [x.rstrip() for x in body.splitlines() if x.strip()]
    table = [x for x in lines if x[0] == x[-1] == "|"]
    if table == lines:
        rows = list(table_rows(lines, False))
        if not rows or sum(not any(r) for r in rows) > len(rows) / 2:
            return "blank_form"
    if re.search(TEMPLATE_HEADING, key(" ".join(s["path"]) or head)) and len(table) >= 3 and len(table) / len(lines) >= 0.7:
        rows = list(table_rows(table, True))
        if not rows or (max(map(len, rows)) >= 5 and sum(map(bool, sum(rows, []))) / sum(map(len, rows)) < 0.45):
            return "sparse_template"
    whole = "\n\n".join(x for x in (s["head"][1] if s["head"] else "", body) if x)
    if len(re.findall(r"\b[A-Z]-\d+(?:[\-–]\d+)?\b", plain(whole))) >= 5 and ((plain(head) and plain(head) == plain(head).upper() and len(plain(head)) <= 24) or "see also" in plain(whole).lower()):
        return "manual_index"
    lines = [x for x in whole.splitlines() if x.strip()]
    hits = sum(bool(re.search(r"\b\d+\s*$", plain(x)) or (x.strip()[0] == "|" and re.search(r"\|\s*[\divxlcdmIVXLCDM]+\s*\|\s*$", x))) for x in lines)
    if "table of contents" in plain(whole).lower() or (len(lines) >= 5 and hits >= max(4, len(lines) // 2)):
        return "contents_list"
    return None


def blocks(lines):
    out, mode = [], None
    for line, page in lines:
        k = klass(line)
        new = "table" if k == "table" else None if k == "blank" else "list" if k == "list" or mode == "list" else "paragraph"
        if new and new != mode:
            out.append((new, []))
        mode = new
        if new:
            out[-1][1].append((line, page))
    return out


def packed(units, limit, join, base=0):
    groups = []
    for u in units:
        if groups and base + len(join(groups[-1] + [u])) <= limit:
            groups[-1].append(u)
        else:
            groups.append([u])
    return groups


def pieces(kind, rows, size, overlap):
    text = "\n".join(x for x, _ in rows).strip()
    if len(text) <= size:
        return [text]
    lines = [x for x, _ in rows]
    if kind == "table":
        if len(lines) < 3:
            return [text]
        return ["\n".join(lines[:2] + g) for g in packed(lines[2:], size, lambda g: "\n".join(lines[:2] + g))]
    if kind == "list":
        items = []
        for x in lines:
            if klass(x) == "list" or not items:
                items.append(x)
            else:
                items[-1] += "\n" + x
        return ["\n".join(g).strip() for g in packed(items, size, lambda g: "\n".join(g).strip())]
    return windows(text, size, overlap)


def clean(t):
    t = re.sub(r"(?i)<br\s*/?>", " ", re.sub(r"(?is)<sup[^>]*>.*?</sup>", "", t))
    t = re.sub(r"\[([^\]]+)\]\(#[^)]*\)", r"\1", re.sub("<[^>]+>", "", t))
    kept, after = [], False
    for x in t.splitlines():
        p = plain(x.replace("|", " ")).lower()
        foot = p.startswith("revision no.") or re.fullmatch(r"page\s+[ivxlcdm\d]+\s+of\s+\d+", p)
        s = x.strip()
        empty = not s or re.fullmatch(r"\|?[-:\s|]+\|?", s) or (s[0] == s[-1] == "|" and not s.strip("|").replace("|", "").strip())
        after = bool(foot or (after and empty))
        if not after:
            kept.append(x)
    return re.sub(r"[ \t]{2,}", " ", re.sub("\n{3,}", "\n\n", "\n".join(kept)).strip())


def passages(text, size=800, overlap=100, most=1500, least=80, bound=2500):
    """(section number, type, first page, last page, text) of one document."""
    for n, s in enumerate(sections(text), 1):
        if dropped(s):
            continue
        raw = s["head"][1] if s["head"] else ""
        whole = "\n\n".join(x for x in (raw, s["body"]) if x)
        if len(whole) <= most:
            parts = [("section", s["page"], s["end"], s["body"])]
        else:
            cells = [(kind, p.strip(), rows[0][1], rows[-1][1]) for kind, rows in blocks(s["lines"]) for p in pieces(kind, rows, size, overlap) if p.strip()]
            groups, base, open_ = [], len(raw) + 2 if raw else 0, False
            for c in cells:
                if open_ and base + len("\n\n".join(x[1] for x in groups[-1] + [c])) <= size:
                    groups[-1].append(c)
                else:
                    groups.append([c])
                open_ = len(groups[-1]) > 1 or base + len(c[1]) < size
            parts = [(g[0][0] if len({x[0] for x in g}) == 1 else "mixed", g[0][2], g[-1][3], "\n\n".join(x[1] for x in g)) for g in groups]
        crumb = "> " + " > ".join(s["path"][:-1]) if len(s["path"]) > 1 else ""
        head = "\n\n".join(x for x in (crumb, raw) if x)
        if len(head) > bound - size - 2:
            head = head[: bound - size - 3] + "…"
        for kind, a, z, body in parts:
            budget = bound - (len(head) + 2 if head else 0)
            for p in [body] if len(body) <= budget else windows(body, budget, overlap):
                t = clean("\n\n".join(x for x in (head, p.strip()) if x)) if p.strip() else ""
                if len(t) >= least:
                    yield n, kind, a, z, t
