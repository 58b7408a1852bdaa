"""Native column functions on text. Nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SPACE = r"[ \t\n\r\x0b\x0c]+"
#: Letters, digits and underscore on both sides of a term's edge.
EDGE_L, EDGE_R = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": " ", "&middot;": "·", "&copy;": "©", "&amp;": "&"}
LANGUAGES = {name: code for code, names in {"en": "english eng", "fr": "french fra", "de": "german deu", "es": "spanish spa", "hi": "hindi hin"}.items() for name in names.split()}
TRACKING = tuple("fbclid gclid igshid mc_cid mc_eid ref_src utm_campaign utm_content utm_id utm_medium utm_source utm_term".split())


def escape(term: str) -> str:
    """A term as a literal, in both Java's and RE2's dialect."""
    return "".join("\\" + c if c in r"\.^$|?*+()[]{}-" else c for c in term)


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, SPACE, " "))


def clean(c: Column) -> Column:
    """Collapsed, and null where nothing is left."""
    return F.nullif(collapse(c), F.lit(""))


def unescape(c: Column) -> Column:
    for k, v in ENTITIES.items():
        c = F.replace(c, F.lit(k), F.lit(v))
    return c


def strip_tags(c: Column) -> Column:
    return collapse(F.regexp_replace(unescape(c), "<[^>]*>", " "))


def clean_title(c: Column, sites: tuple[str, ...] = ()) -> Column:
    """Unescaped and collapsed, without one trailing site name nor dangling separators."""
    out = collapse(unescape(c))
    if sites:
        out = F.regexp_replace(out, r"(?i)\s*[\|:\-–—]\s*(" + "|".join(map(escape, sites)) + r")\s*$", "")
    return F.trim(F.regexp_replace(out, r"[\s:\|\-–—]+$", ""))


#: Publishers whose name may stand at the end of a headline.
PUBLISHERS = tuple(sorted("ABC News|AP|Al Jazeera|Axios|BBC World|BBC|Bloomberg|CBS News|CNBC|CNN|DW|Euronews|FT|Financial Times|Forbes|France24|Global Times|Guardian|Independent|Los Angeles Times|NBC News|NPR|Newsweek|Nikkei Asia|Politico|Reuters|SCMP|Sky News|South China Morning Post|TechCrunch|The Economist|The Guardian|The Hill|The Independent|The Japan Times|The Times of India|The Verge|The Wall Street Journal|The Washington Post|Time|USA Today|WSJ|Wired".split("|"), key=lambda x: (-len(x), x)))


#: Letters whose capital would be several letters, and what SQL's upper has for them: a single capital where there is one, else the letter.
SINGLE = {c: "ẞ" if c == "ß" else c.title() if len(c.title()) == 1 else c for c in map(chr, range(0x10000)) if len(c.upper()) > 1}


def capital(c: Column) -> Column:
    """One letter as one capital letter."""
    return F.when(F.length(F.upper(c)) > 1, F.translate(c, "".join(SINGLE), "".join(SINGLE.values()))).otherwise(F.upper(c))


def clean_headline(c: Column, publishers: tuple[str, ...] = PUBLISHERS) -> Column:
    """A title without its publisher at the end and a Live, Watch, Video, Update, Breaking or Flash at the start, its first letter a capital."""
    out = F.regexp_replace(collapse(unescape(c)), r"(?i)\s*[-–—|]\s*(?:" + "|".join(map(escape, publishers)) + ")$", "")
    out = collapse(F.regexp_replace(out, r"(?i)^(?:Breaking|Flash|Live|Update|Video|Watch)[:\s-]+\s*", ""))
    return F.concat(capital(F.substring(out, 1, 1)), F.substr(out, F.lit(2)))


def clean_author(c: Column) -> Column:
    return F.nullif(F.regexp_replace(collapse(c), r"^(?i:by)\s+", ""), F.lit(""))


def normalize_language(c: Column, default: str = "en") -> Column:
    low = F.lower(F.trim(c))
    base = F.regexp_extract(low, r"^[^-_]*", 0)
    table = F.create_map(*[F.lit(x) for kv in LANGUAGES.items() for x in kv])
    known = F.coalesce(table[low], table[base], F.nullif(base, F.lit("")))
    return F.coalesce(known, F.lit(default))


def hints(c: Column, most: int = 10) -> Column:
    """Lower case, without blanks and repeats, in order, the first few."""
    low = F.transform(c, lambda x: F.lower(collapse(x)))
    return F.slice(F.array_distinct(F.filter(low, lambda x: x.isNotNull() & (x != ""))), 1, most)


def title_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "")


def tokens(c: Column, stopwords: tuple[str, ...] = (), least: int = 3) -> Column:
    """Distinct words of ``least`` letters, or with a digit, in order of appearance."""
    found = F.regexp_extract_all(F.lower(c), F.lit(r"[a-z0-9][a-z0-9'.\-]*"), F.lit(0))
    bare = F.transform(found, lambda x: F.regexp_replace(x, r"['.\-]+$", ""))
    out = F.array_distinct(F.filter(bare, lambda x: (F.length(x) >= least) | x.rlike("^[0-9]+$")))
    return F.array_except(out, F.array(*map(F.lit, stopwords))) if stopwords else out


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def has_any(c: Column, terms) -> Column:
    """Whether any term is there as words of its own, case aside."""
    terms = sorted(set(terms), key=lambda t: (-len(t), t))
    if not terms:
        return F.lit(False)
    return F.coalesce(F.lower(c).rlike(EDGE_L + "(" + "|".join(escape(t.lower()) for t in terms) + ")" + EDGE_R), F.lit(False))


def url_host(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))


def registered_domain(c: Column) -> Column:
    """The last two labels of the host, or three where the last two are short (as in co.uk)."""
    host = F.regexp_replace(url_host(c), r":\d+$", "")
    three = F.regexp_extract(host, r"([^.]+\.(?:co|com|org|net|gov|ac|edu)\.[a-z]{2})$", 1)
    return F.coalesce(F.nullif(three, F.lit("")), F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.lit("")), host)


def is_valid_url(c: Column) -> Column:
    return F.coalesce(F.lower(c).rlike(r"^https?://[^/?#\s]+"), F.lit(False))


def non_article_url(c: Column, segments: tuple[str, ...], hosts: tuple[str, ...] = ()) -> Column:
    """Whether a URL is missing, of a host that only redirects, or has a path segment of a video, live or listing page ("news" is never one)."""
    path = F.lower(F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1))
    own = F.filter(F.split(path, "/"), lambda x: (x != "") & (x != "news"))
    blocked = F.array(*[F.lit(x.strip().lower()) for x in segments if x.strip()]).cast("array<string>")
    wrapper = F.regexp_replace(url_host(c), r":\d+$", "").isin(*hosts) if hosts else F.lit(False)
    return F.coalesce(c, F.lit("")).eqNullSafe("") | F.coalesce(wrapper | F.arrays_overlap(own, blocked), F.lit(False))


def canonicalize_url(c: Column) -> Column:
    """http(s) only: lower-case scheme and host, no trailing slash, no tracking parameters, no fragment."""
    bare = F.regexp_replace(F.trim(c), "#.*$", "")
    head = F.lower(F.regexp_extract(bare, r"^[A-Za-z]+://[^/?]*", 0))
    path = F.regexp_replace(F.regexp_extract(bare, r"^[A-Za-z]+://[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.filter(F.split(query, "&"), lambda q: (q != "") & ~F.lower(F.regexp_extract(q, "^[^=]*", 0)).isin(*TRACKING))
    out = F.concat(head, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))
    return F.when(is_valid_url(c), out)


def parse_time(c: Column) -> Column:
    """Epoch seconds, ISO 8601 or RFC 822; null where it is none of these. Times without a zone are UTC."""
    s = F.trim(c)
    forms = ("yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mmXXX", "yyyy-MM-dd")
    rfc = F.regexp_replace(F.regexp_replace(s, r"^[A-Za-z]{3},\s*", ""), r"\s+(GMT|UT|UTC|Z)$", " +0000")
    tries = [F.try_to_timestamp(s, F.lit(f)) for f in forms] + [F.try_to_timestamp(rfc, F.lit(f)) for f in ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm Z")]
    return F.coalesce(F.when(s.rlike(r"^\d{9,11}$"), F.timestamp_seconds(s.cast("long"))), *tries)


def visible_length(c: Column) -> Column:
    """Length as shown: entities as one character, wide scripts and emoji as two."""
    one = F.regexp_replace(c, r"&(#\d+|[a-zA-Z]+);", "x")
    return F.length(one) + F.regexp_count(one, F.lit(r"[\x{1100}-\x{115F}\x{2E80}-\x{A4CF}\x{AC00}-\x{D7A3}\x{F900}-\x{FAFF}\x{FE30}-\x{FE4F}\x{FF00}-\x{FF60}\x{1F300}-\x{1FAFF}]"))


def escape_html(c: Column) -> Column:
    out = unescape(c)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def escape_html_attr(c: Column) -> Column:
    out = c
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def safe_field(c: Column, most: int = 80) -> Column:
    """One line without double quotes, cut with an ellipsis."""
    one = F.replace(collapse(F.coalesce(c, F.lit(""))), F.lit('"'), F.lit("'"))
    return F.when(F.length(one) > most, F.concat(F.rtrim(F.substring(one, 1, most - 1)), F.lit("…"))).otherwise(one)


def fenced(c: Column) -> Column:
    """``c``, computed where it is defined: a filter on it stays above, as below it would repeat all that ``c`` is made from."""
    return F.when(F.monotonically_increasing_id() >= 0, c)


def rounded(c: Column, places: int = 1) -> Column:
    return F.round(c + F.lit(1e-9), places)
