"""Main text of web pages by tag-path ratios.

A page's text leaves are grouped by their tag path (element names with their
classes and ids, root to leaf). Each path has a text ratio (characters per
leaf) and a punctuation ratio (marks per leaf, and how they vary). The ratios
are smoothed over the neighbouring leaves in page order and fused to one value,
which falls with the share of links (smoothed over the neighbouring paths) and
with class words of furniture (menus, adverts, comments and the like). A path
also has a part of the value of the branches that hold it, so short lines among
long ones stand. The paths whose value reaches the threshold are the content;
where the page names its articles (``article``, else ``main``), only theirs.

Only elements that are furniture by name (``nav``, ``footer``, hidden ones and
the like) go before that. Class words never mark ``html``, ``body``, ``main``
or ``article``, nor an element with most of the page's text and of its articles'.

Defined cases: a null or empty page has the text ''; broken markup is read as
far as it goes (a tag that never closes ends with the page, a cut character
reference stays as it is); rows are judged one by one, so repeated rows repeat.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter, defaultdict

from pyspark.sql import DataFrame, types as T

from payguard.llm.common import map_text

#: Fixed element lists of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg math iframe object textarea title xmp noembed noframes".split())
SKIP = frozenset("nav footer aside button select option label fieldset dialog menu head".split())
#: Never marked by class words.
FRAME = frozenset("html body main article".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong "
                   "sub sup time tt u var br wbr img".split())
PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre div table section article blockquote header footer nav aside main form hr address "
                      "figure fieldset details".split())
#: Closed by the start of the key's element.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, **{t: {"p"} for t in PARAGRAPH}}
CLOSES["li"] = {"li", "p"}
#: Words of classes, ids and roles that mark furniture.
FURNITURE = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted nav navbar navigation menu menubar "
    "breadcrumb breadcrumbs header masthead topbar footer foot sidebar side aside widget widgets comment comments reply replies disqus respond "
    "share sharing social cookie cookies consent notice notices gdpr popup modal overlay newsletter subscribe subscription signup login search "
    "form related recommended recommendations trending popular pagination pager toolbar skip copyright legal disclaimer tags contentinfo "
    "complementary alert toast paywall teaser outbrain taboola hidden print".split())
#: Elements of running text, and the words that don't mark them: a heading may be the page's header.
PROSE = frozenset("h1 h2 h3 h4 h5 h6 p li blockquote figcaption dd dt td th caption pre".split())
MILD = frozenset("header legal copyright disclaimer tags print side".split())
CONTENT = frozenset("article main content post entry story body text".split())
THREAD = frozenset("comment comments reply replies disqus respond".split())
#: An element with this share of the text outside links isn't furniture; a comment thread can be longer than its article.
MOST, NEARLY_ALL = 0.5, 0.9
#: A path stays from this share of the page's fused value on.
THRESHOLD = 0.05
#: What class words of furniture leave of a path's value, and what a path has of its parents' values, level by level.
MARKED, PARENT, LEVELS = 0.02, 0.5, 4
#: The share of link text from which a path is a link list.
LINKS = 0.7
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                   r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
                   r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
#: Levels of a tag path; what lies deeper has the path of its last named level.
DEEPEST = 256
ATTR = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?=[\s=/>]|\Z)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
HREF = re.compile(r"(?<![^\s\"'/])href(?=[\s=/>]|\Z)", re.I)
WORD = re.compile(r"[a-z]+")
SPACE = re.compile(r"[ \t\n\r\f\v  -     　 \u0085]+")
MARKS = frozenset(",.;:!?…。，、؟।")
SCHEMA = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def hidden(tag: str, attrs: str) -> bool:
    """Whether an element is no text of the page by its name or is hidden."""
    if tag in SKIP:
        return True
    for name, *values in ATTR.findall(attrs) if tag not in ("html", "body") else ():
        value, name = "".join(values).lower(), name.lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


def furniture(tag: str, attrs: str) -> float:
    """0, or the share of the page's text from which an element that looks like furniture isn't."""
    if tag in FRAME:
        return 0.0
    if tag == "form":
        return MOST
    for name, *values in ATTR.findall(attrs):
        if name.lower() in ("class", "id", "role"):
            words = set(WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", "".join(values)).lower()))
            if tag in PROSE:
                words -= MILD
            if words & FURNITURE and not (words & CONTENT and not words & {"ad", "ads", "comment", "comments", "footer", "sidebar", "nav", "menu"}):
                return NEARLY_ALL if words & THREAD else MOST
    return 0.0


def leaves(page: str) -> list[tuple[tuple, str, bool, int]]:
    """Text blocks in page order, without hidden ones: (path, text, whether an element
    with class words of furniture holds it, characters in links). A path is a tuple of
    element numbers' labels."""
    stack: list[tuple[str, bool, bool, int]] = []  # tag, whether it is in the path, hidden, the marked element around it
    around: list[int] = [-1]  # of each marked element the one around it; 0 is none
    limit: list[float] = [0.0]
    now = 0
    trail: list[str] = []
    held: Counter = Counter()
    out: list = []
    buffer: list[str] = []
    blocks: list[int] = []  # places in the stack of the elements that aren't inline
    # The open link and its place in the stack; of each block the characters in each link; the block in which a link
    # begins. A link that is never closed counts in that block only.
    link, depth, links = -1, 0, 0
    linked: Counter = Counter()
    begins: dict[int, int] = {}
    owner: tuple = ()
    bad = named_text = False
    mark = 0

    def pop():
        nonlocal now, link
        tag, named, gone, now = stack.pop()
        if link >= 0 and len(stack) <= depth:
            link = -1
        if blocks and blocks[-1] == len(stack):
            blocks.pop()
        held[tag] -= 1
        held["!"] -= gone
        if named:
            trail.pop()
        return tag

    def flush():
        if buffer:
            text = SPACE.sub(" ", entities.unescape("".join(buffer))).strip(" ")
            if text and not bad:
                out.append((owner, text, mark, dict(linked), named_text))
            buffer.clear()
        linked.clear()

    def say(text):
        nonlocal owner, bad, mark, named_text
        if not buffer:
            owner, bad, mark, named_text = tuple(trail), held["!"] > 0, now, held["article"] + held["main"] > 0
        buffer.append(text)
        if link >= 0:
            begins.setdefault(link, len(out))
            linked[link] += len(text)

    pos, n = 0, len(page)
    while pos < n:
        m = TOKEN.search(page, pos)
        if m is None:
            say(page[pos:])
            break
        if m.start() > pos:
            say(page[pos:m.start()])
        pos = m.end()
        close, tag, attrs = m[1] or m[4], (m[2] or m[5] or "").lower(), m[3] or m[6] or ""
        if not tag:
            if m[0].startswith("<![CDATA["):
                say(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        if close:
            if tag not in INLINE:
                flush()
            if tag == "a" and link >= 0:
                begins[link] = -1  # closed
            if held[tag] > 0:
                while pop() != tag:
                    pass
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, pos)
            pos = end.end() if end else n
            continue
        if tag == "br":
            if buffer:
                say("\n")
            continue
        if tag not in INLINE:
            flush()
        closes = CLOSES.get(tag)
        if closes:
            for i in reversed(blocks):
                t = stack[i][0]
                if t in closes:
                    while len(stack) > i:
                        pop()
                    break
                if not (t == "p" or t in ("td", "th") and tag == "tr"):
                    break
        if tag in VOID or attrs.rstrip().endswith("/") and tag in INLINE:
            continue
        if tag == "a":  # a link ends the one before; an anchor without a target is none
            link, depth = (links, len(stack)) if HREF.search(attrs) else (-1, 0)
            links += 1
        label = "" if tag in INLINE else tag
        if label and attrs:
            found = [("".join(v)).lower() for name, *v in ATTR.findall(attrs) if name.lower() in ("class", "id")]
            label += "".join(f".{v}" for v in found)
        gone = hidden(tag, attrs) or tag == "header" and not held["article"] and not held["main"]
        if label:
            blocks.append(len(stack))
        stack.append((tag, named := bool(label) and len(trail) < DEEPEST, gone, now))
        held[tag] += 1
        held["!"] += gone
        if share := furniture(tag, attrs):
            around.append(now)
            limit.append(share)
            now = len(around) - 1
        if named:
            trail.append(label)
    flush()
    out = [(path, text, m, sum(n for a, n in chars.items() if begins[a] in (-1, i)), inside) for i, (path, text, m, chars, inside) in enumerate(out)]
    # Text outside links in each marked element: all, and what articles hold of it.
    size, own = [0] * len(around), [0] * len(around)
    for _, text, m, links, inside in out:
        n = len(text) - min(links, len(text))
        size[m] += n
        own[m] += n * inside
    for m in range(len(around) - 1, 0, -1):
        size[around[m]] += size[m]
        own[around[m]] += own[m]
    marked = [False] * len(around)
    for m in range(1, len(around)):
        wraps = size[m] and size[m] >= limit[m] * size[0] and own[m] >= limit[m] * own[0]
        marked[m] = marked[around[m]] or not wraps
    return [(path, text, marked[m], links) for path, text, m, links, _ in out]


def smooth(values: list[float]) -> list[float]:
    """Weighted means over the neighbours (1, 2, 1)."""
    out = []
    for i, v in enumerate(values):
        a = values[i - 1] if i else v
        b = values[i + 1] if i + 1 < len(values) else v
        out.append((a + 2 * v + b) / 4)
    return out


def main_text(page: str | None) -> str:
    """The blocks of the article, one per line."""
    blocks = [((path, marked), text, min(links, len(text))) for path, text, marked, links in leaves(page or "")]
    # Per tag path (marked leaves apart): text, punctuation, links and leaves.
    paths: dict = defaultdict(lambda: [0, 0, 0, 0])
    for key, text, links in blocks:
        s = paths[key]
        s[0] += len(text)
        s[1] += sum(c in MARKS for c in text)
        s[2] += links
        s[3] += 1
    text_r = smooth([paths[k][0] / paths[k][3] for k, *_ in blocks])
    mark_r = smooth([paths[k][1] / paths[k][3] for k, *_ in blocks])
    runs = [k for i, (k, *_) in enumerate(blocks) if not i or k != blocks[i - 1][0]]
    near: dict = defaultdict(list)  # link shares, smoothed over the neighbouring paths
    for k, v in zip(runs, smooth([paths[k][2] / paths[k][0] for k in runs])):
        near[k].append(v)
    free = {k: 1 - sum(v) / len(v) for k, v in near.items()}
    fused: dict = defaultdict(float)
    for (k, *_), t, m in zip(blocks, text_r, mark_r):
        fused[k] += math.sqrt(t * (1 + m)) * (MARKED if k[1] else 1) / paths[k][3]
    value = {k: v * free[k] for k, v in fused.items()}
    mass = {k: v * paths[k][0] for k, v in value.items()}
    total = sum(mass.values())
    if total <= 0:  # all text is in links
        value = dict(fused)
        free = dict.fromkeys(free, 1.0)
        mass = {k: v * paths[k][0] for k, v in value.items()}
        total = sum(mass.values())
        if total <= 0:
            return ""
    threshold = THRESHOLD * sum(v * value[k] for k, v in mass.items()) / total
    # The value of each branch, and what the page itself says are its articles.
    branch: dict = defaultdict(lambda: [0.0, 0])
    for (path, marked), v in mass.items():
        for i in range(1, len(path) + 1):
            b = branch[path[:i]]
            b[0] += v
            b[1] += paths[path, marked][0]
    named = [b for b in branch if b[-1].split(".")[0] == "article"] or [b for b in branch if b[-1].split(".")[0] == "main"]
    most = max((branch[b][0] for b in named), default=0)
    scope = {b for b in named if branch[b][0] >= most / 2} if most >= 0.25 * total else set()

    def stays(key) -> bool:
        path, marked = key
        inside = any(path[:i] in scope for i in range(1, len(path) + 1))
        if scope and not inside:
            return False
        best = value[key]
        if inside or paths[key][2] < LINKS * paths[key][0]:  # link lists have no value of their parents outside articles
            for up in range(1, min(LEVELS, len(path) - 1) + 1):
                b = path[:-up]
                if b[-1].split(".")[0] in ("html", "body"):
                    break
                best = max(best, branch[b][0] / branch[b][1] * PARENT ** up * free[key] * (MARKED if marked else 1))
                if b in scope:
                    break
        return best >= threshold

    keep = {k for k in paths if stays(k)}
    return "\n".join(text for k, text, _ in blocks if k in keep)


def extract(df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``."""
    def make():
        def run(pages):
            texts = [main_text(p) for p in pages]
            return {"text": texts, "n_chars": [len(t) for t in texts]}
        return run

    out = map_text(df, html, [page_id, url], SCHEMA, make)
    return out.toDF("page_id", "url", "text", "n_chars")
