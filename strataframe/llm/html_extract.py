"""Main text of web pages by equivalence classes of template tokens.

A page is read as a sequence of tokens: its containers, each named by the path
of containers around it, and its texts in their container.  A token's occurrence
vector says how often it stands on each page of a host.  Tokens with the same
vector form an equivalence class; large classes that occur on many pages are the
host's template, because only what the template puts on a page always comes
together and equally often.  Containers hold each other, so the classes of a
template nest by their paths; a class whose tokens don't stand in the template's
order on a page is left out there.  What lies between template tokens are the
slots: by container, what a page puts there beside the template's own words.
Inside article and main elements all blocks are the text but the template's own
words that stand on most pages with that element (``TEXT_SUPPORT``).  A host
without such elements has the slots of text instead: each container whose own
page-specific characters are mostly unlinked, with its blocks but the template's
words that stand on most pages with the container, and lists of links within it.  Names are the second sign: menus, headers, footers, side
columns, notices, adverts, forms and reader comments go by the elements and names
of the containers around them, but no name counts on the way to the main
element, nor on a container that holds most of the host's page-specific text.
Support counts distinct pages, so a page that is repeated makes no template.

A vector is never stored: each page adds a hash of its own number and the
token's count to two sums, and equal sums stand for equal vectors.  So a host
may have any number of pages, and nothing is collected by host but its template,
whose tokens stand on a set share of its pages.
"""

from __future__ import annotations

import functools
import hashlib
import html as html_module
import json
import re
from collections import Counter
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, small_side

#: Hosts with fewer pages use the template of all pages.
LEAST_PAGES = 4
#: Share of a host's pages on which a template token stands, at least.
SUPPORT = 0.3
#: Share of the pages with an article or main element, or with a container of
#: text, on which a text stands, at least, to count as the template's in it too.
TEXT_SUPPORT = 0.8
#: Share of a host's page-specific text beyond which a container is kept against
#: a name made of listed words only; a half is enough against other names.
SURE_NAME = 0.9
#: Tokens of a class, at least.
CLASS_SIZE = 2
#: Elements by what they do to text.
RAW = ("script", "style", "textarea", "title", "iframe", "template", "svg", "noembed", "noframes")
#: Shown as it stands, tags and all.
VERBATIM = "xmp"
CONTAINERS = frozenset(
    "html head body nav header footer aside main article section div form ul ol dl table menu dialog figure fieldset details select button label".split()
)
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th caption blockquote pre hr address figcaption summary center option thead tbody tfoot".split())
CONTENT = ("article", "main")
NAMELESS = frozenset(("html", "body", *CONTENT))
DROPPED = frozenset("head nav header footer aside form menu dialog select button label fieldset".split())
#: Words in class, id or role that name what isn't main text.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation sidebar sidenav aside footer "
    "masthead topbar comment comments reply replies disqus notice notices cookie cookies consent gdpr popup modal overlay share sharing social "
    "breadcrumb breadcrumbs pagination pager newsletter subscribe signup login contentinfo complementary".split()
)
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_RAW_END = {n: re.compile(rf"</{n}\s*>|\Z", re.I) for n in (*RAW, VERBATIM)}
_NAMING = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORDS = re.compile(r"[a-z]+")
_NUMBER = re.compile(r"\d+")
_LONG_NUMBER = re.compile(r"\d{3,}")
_SLASH = re.compile("/")
#: What a start tag of these closes when it is still open.
_CLOSES = {"li": ("li",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",)}


@dataclass
class Block:
    """A text block: its place, its container's path, its text and how many of
    its characters are in links."""

    path: str
    text: str
    linked: int


def _names(rest: str) -> str:
    """The words of a tag's class, id and role.  Numbers that count pages are
    made alike: those of an id, and long ones; the short ones of a class tell
    columns apart."""
    words = []
    for kind, *said in _NAMING.findall(rest) if "=" in rest else ():
        number = _NUMBER if kind.lower() == "id" else _LONG_NUMBER
        words.append(number.sub("#", "".join(said)))
    return ".".join(".".join(words).lower().replace("/", "-").split())


def parse(source: str) -> tuple[list[Block], list[str]]:
    """The text blocks of a page in order, and the paths of its containers in
    the order they open.  A path's parts are element names, with the words of
    class, id and role after dots."""
    blocks: list[Block] = []
    opened: list[str] = []
    stack: list[tuple[str, str]] = []  # open containers: element, path
    parts: list[str] = []
    linked = depth = 0
    path, at = "", 0

    def flush():
        nonlocal parts, linked
        if parts:
            text = " ".join(html_module.unescape("".join(parts)).split())
            if text:
                blocks.append(Block(path, text, linked))
        parts, linked = [], 0

    def add(text: str):
        nonlocal linked
        if text:
            parts.append(text)
            if depth:
                linked += len(text)

    size = len(source)
    while at < size:
        m = _TAG.search(source, at)
        if not m:
            add(source[at:])
            break
        add(source[at : m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            if m[0].startswith("<![CDATA["):
                add(" ")
            continue
        name = name.lower()
        if m["close"]:
            if name == "a":
                depth = max(0, depth - 1)
            elif name in CONTAINERS:
                if any(n == name for n, _ in stack):
                    flush()
                    while stack.pop()[0] != name:
                        pass
                    path = stack[-1][1] if stack else ""
                else:
                    flush()
            elif name in BLOCKS:
                flush()
            continue
        if name == VERBATIM:
            end = _RAW_END[name].search(source, at)
            flush()
            add(html_module.escape(source[at : end.start()]))
            flush()
            at = end.end()
            continue
        if name in RAW and not m["rest"].rstrip().endswith("/"):
            end = _RAW_END[name].search(source, at)
            at = end.end()
            continue
        if name == "a":
            depth += 1
        elif name == "br":
            add(" ")
        elif name in CONTAINERS:
            flush()
            if name in ("html", "body", "head") and any(n == name for n, _ in stack):
                continue
            named = _names(m["rest"])
            path = f"{path}/{name}.{named}" if named else f"{path}/{name}"
            stack.append((name, path))
            opened.append(path)
        elif name in BLOCKS:
            flush()
    flush()
    return blocks, opened


@functools.lru_cache(maxsize=20_000)
def _named(names: str) -> int:
    """How surely names say that a container holds no main text: 2 if one of
    them is made of listed words only (``cookie-notice``), 1 if one has a listed
    word among others (``page-with-nav``), else 0."""
    sure = 0
    for name in names.split("."):
        words = _WORDS.findall(name)
        if not NAMES.isdisjoint(words):
            sure = max(sure, 2 if NAMES.issuperset(words) else 1)
    return sure


@functools.lru_cache(maxsize=20_000)
def dropped(path: str, spared: frozenset[str] = frozenset(), least: int = 1) -> bool:
    """Whether a container on the path holds no main text, by its element (a
    header or footer of an article counts as one too) or, unless its path is
    in ``spared``, its names.  The names of page, body, main and article say
    something of the page, not of what they hold."""
    at = 0
    for part in path.split("/")[1:]:
        at += len(part) + 1
        element, _, names = part.partition(".")
        if element in DROPPED:
            return True
        if names and element not in NAMELESS and _named(names) >= least and path[:at] not in spared:
            return True
    return False


def upto(paths) -> frozenset[str]:
    """The paths and those of all containers around them."""
    return frozenset(p[:k] for p in paths for k in [*(m.start() for m in _SLASH.finditer(p, 1)), len(p)])


@functools.lru_cache(maxsize=20_000)
def content_of(path: str) -> str | None:
    """The path of the outermost article or main element on ``path``."""
    parts = path.split("/")
    for k, part in enumerate(parts):
        if part.partition(".")[0] in CONTENT:
            return "/".join(parts[: k + 1])
    return None


@functools.lru_cache(maxsize=20_000)
def path_hash(path: str) -> str:
    return hashlib.blake2b(path.encode("utf-8", "surrogatepass"), digest_size=4).hexdigest()


def text_token(block: Block) -> str:
    """A text in its container; the last eight characters are the container's."""
    said = hashlib.blake2b(f"{block.path}\0{block.text}".encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()
    return "=" + said + path_hash(block.path)


def token_counts(blocks: list[Block], opened: list[str]) -> dict[str, list]:
    """By token: count, place of the first, characters, and those in links.  A
    container's characters are those of the blocks right inside it."""
    out: dict[str, list] = {}
    for k, p in enumerate(opened):
        out.setdefault(p, [0, k, 0, 0])[0] += 1
    for b in blocks:
        said = out.setdefault(text_token(b), [0, 0, 0, 0])
        said[0] += 1
        for own in (said, out[b.path]) if b.path in out else (said,):
            own[2] += len(b.text)
            own[3] += min(b.linked, len(b.text))
    return out


def _vector_parts(page: int, count: int) -> tuple[int, int]:
    """What a page adds to the two sums of a token that it has ``count`` times."""
    h = ((page ^ (count * 0x9E3779B97F4A7C15)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    h = ((h ^ (h >> 31)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
    return h >> 33, (h >> 2) & 0x7FFFFFFF


def host_of(url: str = "url") -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def distinct_pages(pages: DataFrame) -> DataFrame:
    """``(host, body, lead)``: each body of a host once; of the hosts that share
    a body one leads.  Only bodies that occur again are shuffled."""
    rows = pages.select("host", "body", F.xxhash64("body").alias("digest"))
    again = rows.groupBy("digest").agg(F.count("*").alias("n"), F.min("host").alias("first")).where("n > 1").select("digest", "first")
    again = materialize(again, "repeated-pages")
    met = rows.join(small_side(again, "first"), "digest", "left")
    once = met.where("first is null").select("host", "body", F.lit(True).alias("lead"))
    shared = met.where("first is not null").select("host", "body", (F.col("host") == F.col("first")).alias("lead")).distinct()
    return once.unionByName(shared)


def _tokens(pages: DataFrame) -> DataFrame:
    """Per host, token and ``lead``, the sums over the host's distinct pages."""

    def counted(batches):
        for pdf in batches:
            seen: dict[tuple[str, str, bool], list] = {}
            for host, body, lead in zip(pdf["host"], pdf["body"], pdf["lead"]):
                blocks, opened = parse(body)
                raw = hashlib.blake2b(body.encode("utf-8", "surrogatepass"), digest_size=8).digest()
                page = int.from_bytes(raw, "big")
                own = token_counts(blocks, opened)
                own[""] = [1, 0, 0, 0]  # the page itself
                for token, (n, place, chars, linked) in own.items():
                    a, b = _vector_parts(page, n)
                    sums = seen.setdefault((host, token, bool(lead)), [0, 0, 0, 0, 0, 0])
                    for k, v in enumerate((1, a, b, place, chars, linked)):
                        sums[k] += v
            rows = [(*key, *sums) for key, sums in seen.items()]
            yield pd.DataFrame(rows, columns=["host", "token", "lead", "pages", "va", "vb", "place", "chars", "linked"])

    # sums of 31-bit parts: a host may have 2^32 pages
    schema = "host string, token string, lead boolean, pages long, va long, vb long, place long, chars long, linked long"
    found = distinct_pages(pages).mapInPandas(counted, schema)
    sums = [F.sum(c).alias(c) for c in ("pages", "va", "vb", "place", "chars", "linked")]
    return found.groupBy("host", "token", "lead").agg(*sums)


def _templates(tokens: DataFrame, by_host: bool) -> DataFrame:
    """``(host, template)``: of each host (or all together, host null) the
    tokens of its valid classes in order, as JSON."""
    sums = [F.sum(c).alias(c) for c in ("pages", "va", "vb", "place", "chars", "linked")]
    keyed = tokens.groupBy("host", "token").agg(*sums) if by_host else tokens.where("lead").groupBy("token").agg(*sums).withColumn("host", F.lit("*"))
    whole = keyed.where("token = ''").select("host", F.col("pages").alias("host_pages"))
    if by_host:
        sized = keyed.join(small_side(whole, "host"), "host")
    else:
        total = whole.first()  # one row: all pages
        sized = keyed.withColumn("host_pages", F.lit(total.host_pages if total else 0))
    frequent = sized.where(
        (F.col("token") != "") & (F.col("pages") >= F.col("host_pages") * SUPPORT) & (F.col("pages") >= 2) & (F.col("host_pages") >= LEAST_PAGES)
    )
    entry = F.struct((F.col("place") / F.col("pages")).alias("place"), "token", "chars", "linked")
    classes = frequent.groupBy("host", "pages", "va", "vb").agg(F.array_sort(F.collect_list(entry)).alias("tokens")).where(F.size("tokens") >= CLASS_SIZE)
    one = F.struct(F.col("pages").alias("pages"), "tokens")
    return classes.groupBy("host").agg(F.to_json(F.sort_array(F.collect_list(one), asc=False)).alias("template"))


@dataclass
class Template:
    """A host's template: the classes' container paths in order, the texts that
    belong to it, the paths of its main containers, those of its texts that
    go also inside these and inside slots of text, the containers whose names don't count, and its
    slots: by container the unlinked and linked characters a page puts right
    inside it, without the template's own."""

    classes: list[list[str]]
    texts: frozenset[str]
    roots: tuple[str, ...]
    everywhere: frozenset[str] = frozenset()
    spared: frozenset[str] = frozenset()
    slots: dict[str, tuple[float, float]] = field(default_factory=dict)

    @classmethod
    def of(cls, said: str | None) -> Template:
        classes, texts, own = [], [], {}
        for c in json.loads(said) if said else []:
            paths = []
            for t in c["tokens"]:
                if t["token"].startswith("="):
                    texts.append((t["token"], c["pages"], t["chars"] - t["linked"], t["linked"]))
                else:
                    paths.append(t["token"])
                    own[t["token"]] = [c["pages"], t["chars"] - t["linked"], t["linked"]]
            if paths:
                classes.append(paths)
        places = {path_hash(p): p for p in own}
        for token, _, unlinked, linked in texts:
            if (p := places.get(token[-8:])) is not None:
                own[p][1] -= unlinked
                own[p][2] -= linked
        # names don't count yet: what the pages say decides about them
        mass = {p: u for p, (_, u, _) in own.items() if u > 0 and not dropped(p, least=3)}
        whole = sum(mass.values())
        held: Counter = Counter()
        for p, u in mass.items():
            for q in upto([p]):
                held[q] += u
        found = {r for p in own if not dropped(p, least=3) and (r := content_of(p))}
        roots = {r for r in found if not dropped(r) or 2 * held[r] > whole} or {r for r in found if not dropped(r, least=2)}
        if roots:
            whole = sum(u for p, u in mass.items() if content_of(p) in roots)
        spared = upto(roots) | {
            p for p, u in held.items()
            if (not roots or content_of(p) in roots) and u > whole * (0.5 if _named(p.rpartition("/")[2].partition(".")[2]) < 2 else SURE_NAME)
        }
        if not whole:
            # pages that say nothing of their own are copies: their words stay
            return cls(classes, frozenset(), tuple(sorted(roots)), frozenset(), spared)
        # inside a main element what stands on most pages with that element, elsewhere on most with its container
        around = {token: content_of(p) or p for token, *_ in texts if (p := places.get(token[-8:]))}
        everywhere = {token for token, n, *_ in texts if (r := around.get(token)) in own and n >= TEXT_SUPPORT * own[r][0]}
        slots = {p: (u / n, k / n) for p, (n, u, k) in own.items()}
        return cls(classes, frozenset(t[0] for t in texts), tuple(sorted(roots)), frozenset(everywhere), spared, slots)

    def standing(self, opened: list[str]) -> bool:
        """Whether some class of containers stands on a page, in its order."""
        first: dict[str, int] = {}
        for k, p in enumerate(opened):
            first.setdefault(p, k)
        for c in self.classes:
            places = [first[p] for p in c if p in first]
            if len(places) == len(c) and places == sorted(places):
                return True
        return False


@functools.lru_cache(maxsize=256)
def _template(said: str | None) -> Template:
    return Template.of(said)


def page_roots(opened: list[str]) -> tuple[str, ...]:
    """A page's own main containers; those around which a name speaks against
    main text only where there are no others."""
    for least in (1, 2):
        if found := {content_of(p) for p in opened if not dropped(p, least=least)} - {None}:
            return tuple(found)
    return ()


def in_slot(block: Block, template: Template, here: dict[str, list[int]]) -> bool:
    """Whether a block fills a slot of text: it isn't the template's own, and
    its container's slot is mostly unlinked, or is a list of links within a slot
    of more text.  A container that isn't the template's goes by the page's own
    characters (``here``)."""
    if text_token(block) in template.everywhere:
        return False
    unlinked, linked = template.slots.get(block.path) or here[block.path]
    if unlinked > linked:
        return True
    if text_token(block) in template.texts:
        return False
    around = [p for p in upto([block.path]) if p != block.path and p.rpartition("/")[2].partition(".")[0] not in NAMELESS]
    return linked <= 0 or any(template.slots[p][0] > linked for p in around if p in template.slots)


def extract(source: str, template: Template) -> list[str]:
    """The blocks of a page's main text in page order."""
    blocks, opened = parse(source)
    stands = template.standing(opened)
    roots: tuple[str, ...] = ()
    spared: frozenset[str] = frozenset()
    if stands:
        present = set(opened)
        roots = tuple(r for r in template.roots if r in present)
        spared = template.spared
    if not roots:
        roots = page_roots(opened)
        spared |= upto(roots)
    here: dict[str, list[int]] = {}
    for b in blocks:
        own = here.setdefault(b.path, [0, 0])
        linked = min(b.linked, len(b.text))
        own[0] += len(b.text) - linked
        own[1] += linked
    for least in (1, 2):
        rest = [b for b in blocks if not dropped(b.path, spared, least)]
        if rest:  # else a part of a name alone would take the whole page
            break
    out = []
    for b in rest:
        if roots:
            if any(b.path == r or b.path.startswith(r + "/") for r in roots) and text_token(b) not in template.everywhere:
                out.append(b.text)
        elif in_slot(b, template, here) if stands else text_token(b) not in template.texts:
            out.append(b.text)
    return out


def main_text(pages: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per input row: id, url, ``text`` (the main blocks joined by one
    line feed, empty if there is none) and ``n_chars`` (its code points).

    A null html counts as empty, a null url as a host of its own; hosts of few
    pages use the template of all pages.  Equal rows each give a row, no rows
    give none, further columns are not used."""
    rows = pages.select(
        F.col(id_column).alias("page_id"), F.col(url).alias("url"), host_of(url).alias("host"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("body"),
    )
    tokens = materialize(_tokens(rows.select("host", "body")), "page-tokens")
    templates = materialize(_templates(tokens, by_host=True), "templates")
    # tokens on a set share of all pages: as many as a few pages have
    shared = [r.template for r in _templates(tokens, by_host=False).collect()]
    fallback = shared[0] if shared else None

    @F.pandas_udf("string")
    def texts(bodies: pd.Series, said: pd.Series) -> pd.Series:
        found = ["\n".join(extract(b, _template(t if t is not None else fallback))) for b, t in zip(bodies, said)]
        return pd.Series(found, dtype=object)

    joined = rows.join(small_side(templates, "template"), "host", "left")
    out = joined.select("page_id", "url", texts("body", "template").alias("text"))
    return out.select(F.col("page_id").alias(id_column), F.col("url").alias(url), "text", F.char_length("text").cast("long").alias("n_chars"))
