"""Article links from landed listing pages: embedded state first, then elements, each URL once."""

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.text import non_blank
from ..sources.queues import keep_first
from .web import Page, _safely, embedded_state, feed_entries, is_ev_related, same_site_url

_NOTE = re.compile(r"/(?:explore|discovery/item)/([0-9a-f]{16,32})")
#: (link, title, date text, milliseconds, from the feed of everything: only titles on electric vehicles count)
Entry = tuple[str, str, str, int | None, bool]


def _at(value: object, *steps: str) -> object:
    for step in steps:
        value = value.get(step) if isinstance(value, dict) else None
    return value


def _dicts(value: object) -> Iterable[dict]:
    return (v for v in value if isinstance(v, dict)) if isinstance(value, list) else ()


def _text(page: Page, selector: str, within: int) -> str:
    return next((page.text(i) for i in page.select(selector, within)), "")


def _search_results(page: Page, html: str, url: str) -> Iterator[Entry]:
    """Both shapes of result block; a block needs a headline link to another host."""
    blocks = sorted({*page.select('div.result-op[tpl="news-normal"]'), *page.select("div.result")})
    for block in blocks:
        link = next((i for i in page.select("h3 a[href]", block)), None)
        if link is not None and page.text(link):
            when = next((page.text(i) for i in range(block, page.nodes[block][3] + 1) if page.matches(i, "span.c-color-gray2") or page.matches(i, "p.c-author")), "")
            yield page.nodes[link][1]["href"], page.text(link), when, None, False


def _list_items(page: Page, html: str, url: str) -> Iterator[Entry]:
    for item in page.select("ul.article > li[data-artidanchor]"):
        link = next((i for i in page.select("a[href]", item)), None)
        title = _text(page, "h3", item)
        if link is not None and title:
            yield page.nodes[link][1]["href"], title, _text(page, "span.fn-left", item), None, False


def _channel(page: Page, html: str, url: str) -> Iterator[Entry]:
    """Items of the state whose route leads to an article and whose id is a whole number; else the cards."""
    found = False
    for item in _dicts(_at(embedded_state(page, html, "window.initialState="), "information", "informationList", "itemList")):
        route, key, material = item.get("route"), item.get("itemId"), item.get("templateMaterial")
        if isinstance(route, str) and route.startswith("detail_article") and isinstance(key, int):
            title, at = _at(material, "widgetTitle"), _at(material, "publishTime")
            found = True
            yield f"/p/{key}", title if isinstance(title, str) else "", "", int(at) if isinstance(at, int | float) and not isinstance(at, bool) and abs(at) < 1e15 else None, False
    for i in () if found else page.select("a.article-item-title[href]"):
        if page.text(i) and "/p/" in page.nodes[i][1]["href"]:
            yield page.nodes[i][1]["href"], page.text(i), "", None, False


def _home_feed(page: Page, html: str, url: str) -> Iterator[Entry]:
    """The state's head, content and picture lists without videos, and all article links with a text."""
    props = _at(embedded_state(page, html, "#__NEXT_DATA__"), "props", "pageProps")
    items = [*_dicts(_at(props, "todayNews", "head_article")), *_dicts(_at(props, "todayNews", "content_article"))]
    items += [x for block in _dicts(_at(props, "focusPic")) for x in _dicts(block.get("pic_list"))]
    for item in items:
        key, title = item.get("gid_str") or item.get("group_id"), item.get("title")
        video = item.get("is_video") is True or item.get("article_type") == 2
        if not video and isinstance(key, str) and key.isdigit() and isinstance(title, str) and title.strip():
            yield f"/article/{key}", title.strip(), "", None, False
    for i in page.select('a[href*="/article/"]'):
        path = re.search(r"/article/(\d+)", page.nodes[i][1]["href"])
        if path and page.text(i):
            yield path[0], page.text(i), "", None, False


def _notes(page: Page, html: str, url: str) -> Iterator[Entry]:
    """Notes of the state's feed or search and of the cards. A search already asks for electric vehicles; the feed doesn't."""
    mixed = "/search_result" not in (url or "")
    for item in _dicts(_at(embedded_state(page, html, "window.__INITIAL_STATE__"), "feed" if mixed else "search", "feeds")):
        key, title = item.get("id"), _at(item, "noteCard", "displayTitle")
        if item.get("modelType", "note") in (None, "note") and isinstance(key, str) and re.fullmatch(r"[0-9a-f]{16,32}", key) and isinstance(title, str) and title.strip():
            yield f"/explore/{key}", title.strip(), "", None, mixed
    for section in page.select("section.note-item"):
        for i in [*page.select("a.title[href]", section)][:1]:
            note = _NOTE.search(page.nodes[i][1]["href"])
            if note and page.text(i):
                yield f"/explore/{note[1]}", page.text(i), "", None, mixed


#: How a source lists its articles, and where they are: base address and host ("" for any).
LISTINGS = {
    "baidu_news": (_search_results, "https://news.baidu.com", ""),
    "autohome": (_list_items, "https://www.autohome.com.cn", "autohome.com.cn"),
    "36kr": (_channel, "https://36kr.com", "36kr.com"),
    "dongchedi": (_home_feed, "https://www.dongchedi.com", "dongchedi.com"),
    "xiaohongshu": (_notes, "https://www.xiaohongshu.com", "xiaohongshu.com"),
}


# The words that the news search is asked for, one page of results each.
NEWS_WORDS = ("新能源汽车", "智能驾驶", "智能座舱", "自动驾驶", "电动汽车 软件")


def discover(pages: DataFrame, source: str, as_of: Column, url_col: str = "url", html_col: str = "html", word_col: str | None = None) -> DataFrame:
    """``source_name``, ``source_url``, ``title``, ``publish_date`` and ``ord`` of the listings of one source, each URL once.

    Pages count in the order of their addresses; those of a search in the order of their words in ``NEWS_WORDS`` first
    (``word_col``), so a story that several words find counts under the first of them. Unparseable state leaves the elements; null pages list nothing.
    """
    find, base, host = LISTINGS[source]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if html:
                    entries, _ = _safely(lambda html=html, url=url: tuple(find(Page(html), html, url)))
                    rows += [(url, k, *entry) for k, entry in enumerate(e for e in entries if e)]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
            kinds = (pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["page_url", "pos", "href", "title", "date_text", "millis", "mixed"])

    turn = F.lit(0) if word_col is None else F.array_position(F.array(*(F.lit(w) for w in NEWS_WORDS)), F.col(word_col))
    turns = pages.select(F.col(url_col).alias("page_url"), turn.alias("turn")).groupBy("page_url").agg(F.min("turn").alias("turn"))
    rows = pages.select(F.col(url_col).alias("page_url"), F.col(html_col).alias("html")).mapInArrow(parse, "page_url string, pos int, href string, title string, date_text string, millis long, mixed boolean")
    rows = rows.withColumn("turn", F.lit(0)) if word_col is None else rows.join(turns, "page_url")
    url = same_site_url(F.col("href"), base, host) if host else F.when(F.col("href").rlike("^https?://"), F.col("href"))
    text = non_blank(F.col("date_text"))
    stamp = F.coalesce(dates.epoch_millis(F.col("millis")), dates.result_date(text, as_of))
    named = rows.where(~F.col("mixed") | is_ev_related(F.col("title"))).select(F.lit(source).alias("source_name"), url.alias("source_url"), "title", stamp.alias("publish_date"), F.struct("turn", "page_url", "pos").alias("ord"))
    return keep_first(named, "source_url", "ord")


def discover_feeds(feeds: DataFrame, source: str, xml_col: str = "xml", ord_col: str = "ord") -> DataFrame:
    """The same from RSS feeds, for sources that have them; feeds count in the order of ``ord``."""
    entries = feeds.select(F.col(ord_col).alias("feed"), F.col(xml_col).alias("xml"))
    rows = feed_entries(entries, "xml", keep=["feed"]).withColumnRenamed("url", "source_url")
    named = rows.select(F.lit(source).alias("source_name"), "source_url", "title", "publish_date", F.struct("feed", "pos").alias("ord"))
    return keep_first(named, "source_url", "ord")
