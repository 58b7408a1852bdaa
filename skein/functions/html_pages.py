"""HTML, feeds and images on the executors: Python-side parsing where built-in functions can't."""

from __future__ import annotations

import json
import re
import struct
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit, urlunsplit
from xml.etree import ElementTree

from .text import TRACKING

LIST_KEYS = "articles data results items rows entries".split()
PAYWALL = re.compile(r"(?:continue reading|subscribe to (?:read|continue)|subscribers? only|already a subscriber)", re.I)
UNSUITABLE = re.compile(r"(?:^|[/_.\-])(?:logo|icon|avatar|sprite|pixel|badge|banner|placeholder|spacer|button|ads?)(?:[/_.\-]|$)", re.I)


class ParseError(ValueError):
    pass


def canonical(url: str | None, base: str | None = None) -> str | None:
    """Absolute http(s) URL without tracking parameters, fragment and trailing slash; None otherwise."""
    if not (url or "").strip():
        return None
    try:
        p = urlsplit(urljoin(base or "", url.strip()))
    except ValueError:
        return None
    if p.scheme.lower() not in ("http", "https") or not p.netloc:
        return None
    query = "&".join(q for q in p.query.split("&") if q and q.split("=")[0].lower() not in TRACKING)
    return urlunsplit((p.scheme.lower(), p.netloc.lower(), p.path.rstrip("/"), query, ""))


def _item(title, url, summary=None, published=None, updated=None, author=None, tags=(), raw=None) -> dict:
    return {"title": title, "url": url, "summary": summary, "published": published, "updated": updated, "author": author, "category_hints": list(tags), "raw": raw}


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1].lower()


def _salvaged(content: bytes) -> list:
    """The whole entries of a broken feed that are sound by themselves."""
    text, found = content.decode("utf-8", "replace"), []
    for m in re.finditer(r"<(item|entry)\b[^>]*>(.*?)</\1\s*>", text, re.S | re.I):
        plain = re.sub(r"(</?)[A-Za-z][\w.-]*:", r"\1", m.group(2))  # without prefixes, whose names were declared further up
        plain = re.sub(r"\s[A-Za-z][\w.-]*:([\w.-]+=)", r" \1", plain)
        try:
            found.append(ElementTree.fromstring(f"<item>{plain}</item>"))
        except ElementTree.ParseError:
            continue
    return found


def parse_rss(content: bytes, base: str | None = None) -> list[dict]:
    """RSS or Atom entries with title and link; raises only if the feed is broken and holds none."""
    out: list[dict] = []
    try:
        entries = [n for n in ElementTree.fromstring(content).iter() if _local(n.tag) in ("item", "entry")]
    except ElementTree.ParseError as e:
        entries = _salvaged(content)
        if not entries:
            raise ParseError(str(e)) from e
    for node in entries:
        got: dict[str, str] = {}
        tags: list[str] = []
        for x in node:
            name, text = _local(x.tag), " ".join("".join(x.itertext()).split())
            if name == "category":
                tags.append(x.get("term") or text)
            elif name == "link":
                got.setdefault("link", x.get("href") or text)
            else:
                got.setdefault(name, text)
        url = canonical(got.get("link") or got.get("guid") or got.get("id"), base)
        if got.get("title") and url:
            out.append(_item(got["title"], url, got.get("summary") or got.get("description"), got.get("published") or got.get("pubdate") or got.get("date"), got.get("updated"), got.get("author") or got.get("creator"), [t for t in tags if t]))
    return out


def _listed(data) -> list:
    if isinstance(data, list):
        return data
    if isinstance(data, dict):
        for k in LIST_KEYS:
            if isinstance(data.get(k), list):
                return data[k]
        if isinstance(data.get("data"), dict):
            return _listed({k: v for k, v in data["data"].items() if k in ("articles", "results", "items")})
    raise ParseError("no list of items")


def parse_json(content: bytes, settings: dict | None = None, base: str | None = None) -> list[dict]:
    """Items of an API answer; ``settings`` may map our field names to the source's."""
    try:
        rows = _listed(json.loads(content))
    except ValueError as e:
        raise ParseError(str(e)) from e
    s, out = settings or {}, []
    pick = lambda row, name, *others: next((row[k] for k in (s.get(name), name, *others) if k and row.get(k)), None)
    for row in rows:
        if not isinstance(row, dict):
            continue
        tags = pick(row, "tags", "categories", "keywords") or []
        url, title = canonical(pick(row, "url", "link"), base), pick(row, "title", "headline")
        if url and title:
            out.append(_item(title, url, pick(row, "summary", "description"), pick(row, "published", "published_at", "date"), pick(row, "updated", "updated_at"), pick(row, "author"), [tags] if isinstance(tags, str) else [str(t) for t in tags], json.dumps(row, sort_keys=True)))
    return out


class _Links(HTMLParser):
    """Anchors with their text; one that is not closed ends where the next begins."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, list[str]]] = []
        self.inside = False

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            target = next((v for k, v in attrs if k == "href" and v), None)
            self.inside = target is not None
            if target is not None:
                self.found.append((target, []))

    def handle_endtag(self, tag):
        self.inside = self.inside and tag != "a"

    def handle_data(self, data):
        if self.inside:
            self.found[-1][1].append(data)

    def anchors(self) -> list[tuple[str, str]]:
        return [(target, " ".join("".join(parts).split())) for target, parts in self.found]


def allowed(url: str, domains) -> bool:
    host = urlsplit(url).netloc.split(":")[0]
    return not domains or any(host == d or host.endswith("." + d) for d in domains)


def links(page: str | bytes | None, base: str | None = None, domains=()) -> list[dict]:
    """Anchors of a page: resolved, canonical, first of each URL, of the allowed domains."""
    p = _Links()
    p.feed(page.decode("utf-8", "replace") if isinstance(page, bytes) else page or "")
    out: dict[str, dict] = {}
    for href, text in p.anchors():
        if not href or href.startswith("#") or re.match(r"(?:mailto|javascript|tel|data):", href, re.I):
            continue
        url = canonical(href, base)
        if url and text and url not in out and allowed(url, domains):
            out[url] = _item(text, url)
    return list(out.values())


def parse(method: str, content: bytes, url: str | None = None, settings: dict | None = None, domains=()) -> list[dict]:
    if method in ("rss", "discovery"):
        return parse_rss(content, url)
    if method in ("json", "api", "endpoint"):
        return parse_json(content, settings, url)
    if method == "page":
        return links(content, url, domains)
    raise ParseError(f"unknown method {method!r}")


class _Media(HTMLParser):
    def __init__(self, base):
        super().__init__(convert_charrefs=True)
        self.base, self.found, self.stack = base, [], []

    def add(self, kind, origin, url, width=None, height=None):
        full = urljoin(self.base or "", (url or "").strip())
        if url and full.startswith(("http://", "https://")):
            self.found.append({"kind": kind, "origin": origin, "url": full, "width": _int(width), "height": _int(height), "container": " ".join(self.stack)[-200:]})

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        name = (a.get("property") or a.get("name") or "").lower()
        if tag == "meta" and name in ("og:image", "og:image:url", "og:image:secure_url", "twitter:image", "twitter:image:src"):
            self.add("image", "meta", a.get("content"))
        elif tag == "meta" and name in ("og:video", "og:video:url", "og:video:secure_url"):
            self.add("video", "meta", a.get("content"))
        elif tag == "link" and a.get("rel") == "image_src":
            self.add("image", "link", a.get("href"))
        elif tag == "img":
            self.add("image", "img", best_srcset(a.get("srcset") or a.get("data-srcset")) or a.get("src") or a.get("data-src") or a.get("data-original") or a.get("data-lazy-src"), a.get("width"), a.get("height"))
        elif tag in ("video", "source") and a.get("src"):
            self.add("video", tag, a.get("src"))
        if tag not in ("meta", "link", "img", "br", "hr", "input", "source"):
            self.stack.append(f"{a.get('class') or ''} {a.get('id') or ''}".strip())

    def handle_endtag(self, tag):
        if self.stack:
            self.stack.pop()


def _int(value) -> int | None:
    try:
        return int(float(re.sub(r"px$", "", str(value).strip()))) if value is not None else None
    except ValueError:
        return None


def best_srcset(value: str | None) -> str | None:
    """The widest candidate, or the first where none says its width."""
    best, width = None, -1
    for part in re.split(r",\s+", value or ""):
        x = part.split()
        w = int(x[1][:-1]) if len(x) > 1 and re.fullmatch(r"\d+w", x[1]) else 0
        if x and w > width:
            best, width = x[0], w
    return best


def media(page: str | None, base: str | None = None) -> list[dict]:
    p = _Media(base)
    p.feed(page or "")
    return p.found


def suitable(m: dict, least: tuple[int, int] = (300, 200)) -> bool:
    small = m["kind"] == "image" and (m["width"] is not None and m["width"] < least[0] or m["height"] is not None and m["height"] < least[1])
    return not small and not UNSUITABLE.search(urlsplit(m["url"]).path) and not UNSUITABLE.search(m["container"].replace(" ", "/"))


def select_media(found: list[dict]) -> dict | None:
    """Pages' own meta images, then images by area, then videos: the first that is suitable."""
    order = [m for m in found if m["kind"] == "image" and m["origin"] != "img"]
    order += sorted((m for m in found if m["origin"] == "img"), key=lambda m: -(m["width"] or 0) * (m["height"] or 0))
    order += [m for m in found if m["kind"] == "video"]
    return next((m for m in order if suitable(m)), None)


def image_size(data: bytes | None) -> tuple[int, int] | None:
    """Width and height from the header of a PNG, GIF, JPEG or WebP (VP8X, VP8L)."""
    d = data or b""
    try:
        if d[:8] == b"\x89PNG\r\n\x1a\n":
            return struct.unpack(">II", d[16:24])
        if d[:6] in (b"GIF87a", b"GIF89a"):
            return struct.unpack("<HH", d[6:10])
        if d[:4] == b"RIFF" and d[8:12] == b"WEBP":
            if d[12:16] == b"VP8X":
                return 1 + int.from_bytes(d[24:27], "little"), 1 + int.from_bytes(d[27:30], "little")
            if d[12:16] == b"VP8L":
                v = int.from_bytes(d[21:25], "little")
                return (v & 0x3FFF) + 1, (v >> 14 & 0x3FFF) + 1
        if d[:2] == b"\xff\xd8":
            at = 2
            while at + 9 <= len(d):
                if d[at] != 0xFF:
                    at += 1
                    continue
                marker = d[at + 1]
                if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                    h, w = struct.unpack(">HH", d[at + 5 : at + 9])
                    return w, h
                if marker in (0xFF, 0x01) or 0xD0 <= marker <= 0xD9:
                    at += 1 if marker == 0xFF else 2
                    continue
                at += 2 + struct.unpack(">H", d[at + 2 : at + 4])[0]
    except struct.error:
        return None
    return None


def article_text(page: str | None) -> tuple[str, str]:
    """(status, text) of an article page: paragraphs outside navigation; paywalled and empty pages are told apart."""
    body = re.sub(r"<(script|style|nav|header|footer|aside|form)\b.*?</\1\s*>", " ", page or "", flags=re.S | re.I)
    if not re.search(r"<(?:html|body|p|div)\b", body, re.I):
        return "not_html", ""
    paragraphs = [" ".join(re.sub(r"<[^>]*>", " ", p).split()) for p in re.findall(r"<p\b[^>]*>(.*?)(?=</p|<p\b|$)", body, re.S | re.I)]
    text = "\n".join(p for p in paragraphs if len(p) > 20)
    if len(text) < 200 and PAYWALL.search(body):
        return "paywall", ""
    return ("ok", text) if text else ("no_text", "")
