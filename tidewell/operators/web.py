"""Articles and listings from landed pages: a selector spec for each source, one small parser, dates as column expressions."""

import json
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.text import any_keyword, non_blank

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_HIDDEN = frozenset(("script", "style", "noscript", "template"))


class Page(HTMLParser):
    """The elements of a page in order: (tag, attributes, parent, last descendant), and text runs by element."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[list] = [["", {}, -1, 0]]
        self.texts: list[tuple[int, str]] = []
        self.open = [0]
        self.feed(html)
        self.close()
        for i in range(len(self.nodes) - 1, 0, -1):
            p = self.nodes[i][2]
            self.nodes[i][3] = max(self.nodes[i][3], i)
            self.nodes[p][3] = max(self.nodes[p][3], self.nodes[i][3])

    def handle_starttag(self, tag, attrs):
        if tag == "p" and self.nodes[self.open[-1]][0] == "p":
            self.open.pop()
        self.nodes.append([tag, {k: v or "" for k, v in attrs}, self.open[-1], 0])
        if tag not in _VOID:
            self.open.append(len(self.nodes) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.open.pop()

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.nodes[self.open[k]][0] == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        self.texts.append((self.open[-1], data))

    def select(self, selector: str, within: int = 0) -> Iterator[int]:
        """Elements by ``tag#id.class[attr*=value] descendant``, with ``>`` for a child."""
        *outer, last = re.findall(r">|[^\s>]+", selector)
        for i in range(within + 1, self.nodes[within][3] + 1):
            if _is(self.nodes[i], last) and self._under(i, outer, within):
                yield i

    def matches(self, i: int, simple: str) -> bool:
        return _is(self.nodes[i], simple)

    def _under(self, i: int, outer: list[str], within: int) -> bool:
        if not outer:
            return True
        direct = outer[-1] == ">"
        rest = outer[:-1] if direct else outer
        p = self.nodes[i][2]
        while p > within or p > 0:
            if _is(self.nodes[p], rest[-1]) and self._under(p, rest[:-1], within):
                return True
            if direct:
                return False
            p = self.nodes[p][2]
        return False

    def text(self, i: int, joiner: str = " ", without: tuple[str, ...] = ()) -> str:
        """Stripped text runs below an element, but for scripts and the like and what ``without`` selects."""
        end = self.nodes[i][3]
        dropped = [(j, max(j, self.nodes[j][3])) for s in without for j in self.select(s, i)]
        dropped += [(j, max(j, self.nodes[j][3])) for j in range(i + 1, end + 1) if self.nodes[j][0] in _HIDDEN]
        runs = (t.strip() for j, t in self.texts if i <= j <= end and not any(a <= j <= b for a, b in dropped))
        return joiner.join(t for t in runs if t)

    def raw(self, i: int) -> str:
        return "".join(t for j, t in self.texts if j == i)


def _is(node: list, simple: str) -> bool:
    tag, attrs = node[0], node[1]
    for kind, value in re.findall(r"(^|[#.\[])([^#.\[\]]+)", simple):
        if kind == "" and tag != value:
            return False
        if kind == "#" and attrs.get("id") != value:
            return False
        if kind == "." and value not in attrs.get("class", "").split():
            return False
        if kind == "[":
            name, op, want = re.fullmatch(r"([\w-]+)(\*?=)?\"?([^\"]*)\"?", value).groups()
            if name not in attrs or op == "=" and attrs[name] != want or op == "*=" and want not in attrs[name]:
                return False
    return True


@dataclass(frozen=True)
class Source:
    """Where a source's pages keep the fields. State: a script's JSON; paths in it come first, elements after."""

    name: str
    language: str
    title: tuple[str, ...]
    body: tuple[str, ...]
    joiner: str = "\n"
    without: tuple[str, ...] = ()
    paragraphs: str = ""
    text_without_paragraphs: bool = False
    state: str = ""
    state_path: tuple[str, ...] = ()
    state_fields: tuple[str, str, str] = ("", "", "")
    date_meta: tuple[str, ...] = ()
    date_element: str = ""
    date_zone: str = "UTC"
    date_kind: str = "iso"
    largest_block: bool = False
    title_trim: tuple[str, str] = ("", "")
    first_line_title: bool = False


# Words by which a note counts as being about electric vehicles.
EV_KEYWORDS = (
    "电动车", "电车", "新能源", "智能驾驶", "智驾", "辅助驾驶", "自动驾驶", "智能座舱", "充电桩", "超充", "补能", "续航", "增程", "激光雷达", "noa", "ota", "提车", "试驾", "车主", "比亚迪",
    "byd", "腾势", "方程豹", "仰望", "蔚来", "nio", "乐道", "小鹏", "xpeng", "理想汽车", "理想l", "理想i", "理想mega", "问界", "智界", "享界", "尊界", "鸿蒙智行", "极氪", "zeekr",
    "零跑", "小米汽车", "su7", "yu7", "特斯拉", "tesla", "model 3", "model y", "埃安", "深蓝", "阿维塔", "岚图", "智己", "极狐", "哪吒",
)
# Words of one search a day, in turn.
SEARCH_WORDS = ("电动车评测", "新能源车体验", "智能驾驶体验", "BYD车主", "蔚来体验", "小鹏汽车", "理想汽车", "华为车")

_PUBLISHED = ("article:published_time", "og:article:published_time")
SOURCES = {
    s.name: s
    for s in (
        Source("gasgoo", "en", ("h1",), ("div.article-content",), date_meta=_PUBLISHED[:1]),
        Source("cnevpost", "en", ("h1.entry-title", "h1"), ("div.entry-content",), without=("div.subscription-container", "div.danpian-xiangguan-post"), date_meta=_PUBLISHED[:1]),
        Source("baidu_news", "zh", ("h1", "meta:og:title", "title"), ("article", "div.article-content", "div.post-content", "#content", "div.content"), date_meta=_PUBLISHED, date_zone="+08:00", date_kind="text", largest_block=True),
        Source("autohome", "zh", ("title",), ("#parent-container",), paragraphs="p.editor-paragraph", title_trim=("【图】", "_汽车之家"), state="#__NEXT_DATA__", state_path=("props", "pageProps", "articleContent"), state_fields=("title", "content", "publishDate"), date_zone="+08:00", date_kind="seconds"),
        Source("36kr", "zh", ("h1.article-title", "h1"), ("div.articleDetailContent",), state="window.initialState=", state_path=("articleDetail", "articleDetailData", "data"), state_fields=("widgetTitle", "widgetContent", "publishTime"), date_meta=_PUBLISHED[:1], date_zone="+08:00", date_kind="millis"),
        Source("dongchedi", "zh", ("h1",), ("#article",), paragraphs="p", text_without_paragraphs=True, state="#__NEXT_DATA__", state_path=("props", "pageProps", "article"), state_fields=("title", "content", "publish_time"), date_element="span.time", date_zone="+08:00", date_kind="epoch"),
        Source("xiaohongshu", "zh", ("#detail-title",), ("#detail-desc span.note-text", "#detail-desc"), joiner=" ", state="window.__INITIAL_STATE__", state_path=("note", "noteDetailMap", "*", "note"), state_fields=("title", "desc", "time"), date_element="span.date", date_zone="+08:00", date_kind="note", first_line_title=True),
    )
}
#: The order in which sources run.
SOURCE_RANK = {name: i for i, name in enumerate(SOURCES)}


def embedded_state(page: Page, html: str, where: str) -> dict:
    """The JSON object that a script holds: by the script's id, or after an assignment; nothing if it doesn't parse."""
    if where.startswith("#"):
        found = next((page.raw(i) for i in page.select("script" + where)), "")
    else:
        at = html.find(where)
        found = html[at + len(where) :].lstrip(" =\n") if where and at >= 0 else ""
        found = re.sub(r"\bundefined\b", "null", found) if "__" in where else found
    try:
        value = json.JSONDecoder().raw_decode(found.strip())[0]
    except (ValueError, RecursionError):
        return {}
    return value if isinstance(value, dict) else {}


def _state(page: Page, html: str, spec: Source, url: str) -> dict:
    """The JSON object that holds the article, or nothing."""
    value = embedded_state(page, html, spec.state) if spec.state else {}
    for step in spec.state_path:
        if step == "*" and isinstance(value, dict):
            own = re.search(r"/(?:explore|discovery/item)/([0-9a-f]{16,32})", url or "")
            value = value.get(own[1]) if own and own[1] in value else next(iter(value.values())) if len(value) == 1 else None
        else:
            value = value.get(step) if isinstance(value, dict) else None
    return value if isinstance(value, dict) else {}


def _body_of(page: Page, i: int, spec: Source, paragraphs: str) -> str:
    if not paragraphs:
        return page.text(i, spec.joiner, spec.without)
    joined = "\n".join(t for t in (page.text(p) for p in page.select(paragraphs, i)) if t)
    return joined or (page.text(i) if spec.text_without_paragraphs else "")


def extract(html: str | None, url: str, spec: Source) -> tuple[str, str, str, str, str]:
    """Title, body, the state's date, the meta or element's date, and all text if the date may stand anywhere."""
    if not html:
        return "", "", "", "", ""
    page = Page(html)
    meta = {page.nodes[i][1].get("property", ""): page.nodes[i][1].get("content", "") for i in page.select("meta") if page.nodes[i][1].get("content")}
    state = _state(page, html, spec, url)
    t, b, d = (state.get(k) if k else None for k in spec.state_fields)
    title = t.strip() if isinstance(t, str) else ""
    for s in () if title else spec.title:
        title = meta.get(s[5:], "").strip() if s.startswith("meta:") else next((page.text(i) for i in page.select(s)), "")
        if title:
            title = title.removeprefix(spec.title_trim[0]).removesuffix(spec.title_trim[1]).strip()
            break
    body = ""
    if isinstance(b, str) and b.strip():
        inner = Page(b)
        body = _body_of(inner, 0, spec, spec.paragraphs and "p") if "<" in b else b.strip()
    for s in () if body else spec.body:
        body = next((x for x in (_body_of(page, i, spec, spec.paragraphs) for i in page.select(s)) if x), "")
        if body:
            break
    if not body and spec.largest_block:
        blocks = ("\n".join(page.text(p) for p in page.select("p", i) if page.nodes[p][2] == i) for k in ("div", "section") for i in page.select(k))
        body = max(blocks, key=len, default="") or "\n".join(x for x in (page.text(p) for p in page.select("p")) if x)
    if not title and spec.first_line_title and body:
        title = body.split("\n", 1)[0]
    stamp = next((meta[m] for m in spec.date_meta if m in meta), "") or (next((page.text(i) for i in page.select(spec.date_element)), "") if spec.date_element else "")
    return title, body, "" if d is None or isinstance(d, bool) else str(d), stamp, page.text(0) if spec.date_kind in ("text", "seconds") else ""


def publish_date(spec: Source, as_of: Column) -> Column:
    """UTC timestamp from what ``extract`` found, or null."""
    state, stamp, text = F.col("state_date"), F.col("stamp"), F.col("page_text")
    meta = dates.parse_iso(non_blank(stamp), spec.date_zone)
    if spec.date_kind == "millis":
        return F.coalesce(dates.epoch_millis(state.try_cast("long")), meta)
    if spec.date_kind == "epoch":
        return F.coalesce(F.when(state.try_cast("double") > 0, F.timestamp_seconds(state.try_cast("double"))), dates.absolute_date(stamp, seconds=True))
    if spec.date_kind == "note":
        return F.coalesce(dates.epoch_millis_or_seconds(state.try_cast("double")), dates.note_date(stamp, as_of))
    if spec.date_kind == "seconds":
        return F.coalesce(dates.absolute_date(state, seconds=True), dates.absolute_date(text, seconds=True))
    if spec.date_kind == "text":
        full = dates.absolute_date(text)
        return F.coalesce(meta, full, dates.month_day(text, as_of))
    return meta


def _safely(extracted: Callable[[], tuple]) -> tuple[tuple, str | None]:
    """What a page gives, or five blanks and the error's name: one bad page costs its own row only."""
    try:
        return extracted(), None
    except (ArithmeticError, AttributeError, LookupError, RecursionError, TypeError, ValueError) as e:
        return ("",) * 5, type(e).__name__


def parsed_pages(pages: DataFrame, source: str, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """What ``extract`` finds on each landed page of one source, and ``parse_error``, the error that a page raised."""
    spec = SOURCES[source]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(*found, error) for found, error in (_safely(lambda h=h, u=u: extract(h.as_py(), u.as_py(), spec)) for u, h in zip(batch.column(0), batch.column(1), strict=True))]
            fields = list(zip(*rows, strict=True)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(f, pa.string()) for f in fields)], ["source_url", "raw_html", "title", "body", "state_date", "stamp", "page_text", "parse_error"])

    landed = pages.select(F.col(url_col).alias("source_url"), F.col(html_col).alias("raw_html"))
    return landed.mapInArrow(parse, "source_url string, raw_html string, title string, body string, state_date string, stamp string, page_text string, parse_error string")


def scrape_articles(pages: DataFrame, source: str, as_of: Column, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Article rows of landed pages of one source; pages without a title or a body, or that can't be parsed, are left out."""
    spec = SOURCES[source]
    found = parsed_pages(pages, source, url_col, html_col).where("title <> '' AND body <> ''")
    return found.select(F.lit(spec.name).alias("source_name"), "source_url", "title", "body", publish_date(spec, as_of).alias("publish_date"), as_of.alias("scrape_date"), F.lit(spec.language).alias("language"), "raw_html")


def feed_entries(feeds: DataFrame, xml_col: str = "xml", keep: Sequence[str] = ()) -> DataFrame:
    """Entries of RSS feeds, one XML text each: ``url``, ``title``, ``publish_date``, ``pos``; a feed that doesn't parse has none."""
    item = "array<struct<title: string, link: string, pubDate: string>>"
    parsed = F.from_xml(F.col(xml_col), f"channel struct<item: {item}>", {"mode": "PERMISSIVE"})
    rows = feeds.select(*keep, F.posexplode(parsed["channel"]["item"]).alias("pos", "i"))
    day = F.regexp_replace(F.col("i.pubDate"), r"^[A-Za-z]+,\s*", "")
    stamp = F.coalesce(F.try_to_timestamp(day, F.lit("d MMM yyyy HH:mm:ss z")), F.try_to_timestamp(day, F.lit("d MMM yyyy HH:mm:ss Z")))
    return rows.select(F.trim("i.link").alias("url"), F.trim("i.title").alias("title"), stamp.alias("publish_date"), "pos", *keep)


def same_site_url(href: Column, base: str, host: str) -> Column:
    """Absolute URL without a fragment; null for other hosts and other schemes."""
    plain = F.trim(F.split_part(href, F.lit("#"), F.lit(1)))
    url = F.when(plain.startswith("//"), F.concat(F.lit("https:"), plain)).when(plain.startswith("/"), F.concat(F.lit(base), plain)).otherwise(plain)
    return F.when((url.startswith("http://") | url.startswith("https://")) & F.contains(url, F.lit(host)), url)


def note_url(url: Column, base: str) -> Column:
    """The address of a note without tokens; other addresses lose their query."""
    note = F.regexp_extract(url, r"/(?:explore|discovery/item)/([0-9a-f]{16,32})", 1)
    return F.when(note != "", F.concat(F.lit(f"{base}/explore/"), note)).otherwise(F.split_part(url, F.lit("?"), F.lit(1)))


def is_ev_related(title: Column) -> Column:
    return any_keyword(title, EV_KEYWORDS)


def search_word(as_of: Column) -> Column:
    return F.element_at(F.array(*(F.lit(w) for w in SEARCH_WORDS)), F.dayofyear(as_of) % len(SEARCH_WORDS) + 1)


def links(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Anchors of landed listing pages, in order: ``ord``, ``href``, ``title``; scripts are removed first."""
    clean = F.regexp_replace(F.col(html_col), r"(?is)<(script|style|noscript)\b.*?</\1>", " ")
    anchors = F.regexp_extract_all(clean, F.lit(r"(?is)<a\s[^>]*?href\s*=\s*[\"'][^\"']*[\"'][^>]*>.*?</a>"), F.lit(0))
    rows = pages.select("*", F.posexplode(anchors).alias("ord", "anchor"))
    title = F.trim(F.regexp_replace(F.regexp_replace("anchor", r"(?s)<[^>]+>", " "), r"\s+", " "))
    return rows.select(*pages.columns, "ord", F.regexp_extract("anchor", r"(?is)href\s*=\s*[\"']([^\"']*)[\"']", 1).alias("href"), title.alias("title"))
