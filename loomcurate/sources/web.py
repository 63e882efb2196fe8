"""Feeds and pages. Fetching is a function ``fetch(url) -> (status, body)`` that runs in the partitions."""

from __future__ import annotations

import time
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC
from email.utils import parsedate_to_datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import keyed
from ..runtime import ready
from ..schemas import DISCOVERED, FEEDS

Fetch = Callable[[str], tuple[int, str]]


def http_fetch(url: str, timeout: float = 20.0) -> tuple[int, str]:
    import urllib.request

    with urllib.request.urlopen(url, timeout=timeout) as reply:
        return reply.status, reply.read().decode(reply.headers.get_content_charset() or "utf-8", "replace")


def opml_feeds(documents: DataFrame, xml: str = "xml") -> DataFrame:
    """name, feed_url, site_url, position: every outline with a feed, in document order, nested ones too.

    The name is the outline's text, else its title, else ``Unknown``.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for body in part["xml"]:
                for o in ET.fromstring(body).iter("outline"):
                    if o.get("xmlUrl"):
                        rows.append((o.get("text") or o.get("title") or "Unknown", o.get("xmlUrl"), o.get("htmlUrl"), len(rows)))
            yield pd.DataFrame(rows, columns=["name", "feed_url", "site_url", "position"])

    ready(documents.sparkSession)
    return documents.select(F.col(xml).alias("xml")).mapInPandas(run, f"{FEEDS.ddl}, position int")


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def feed_entries(body: str) -> Iterator[dict]:
    """Entries of an RSS or Atom feed with a link, in order; a broken feed gives those before the break."""
    parser = ET.XMLPullParser(["end"])
    try:
        parser.feed(body)
        for _, node in parser.read_events():
            if _local(node.tag) not in ("item", "entry"):
                continue
            entry = {"url": "", "title": None, "date": None, "categories": []}
            for x in node:
                kind, value = _local(x.tag), (x.text or "").strip()
                if kind == "link" and not entry["url"] and x.get("rel", "alternate") == "alternate":
                    entry["url"] = x.get("href") or value
                elif kind == "title":
                    entry["title"] = value or None
                elif kind in ("pubDate", "published") or kind == "updated" and not entry["date"]:
                    entry["date"] = value or None
                elif kind == "category":
                    entry["categories"].append(x.get("term") or value)
            if entry["url"]:
                yield entry | {"title": entry["title"] or "Untitled"}
    except ET.ParseError:
        return


def entry_time(date: str | None) -> str | None:
    """A feed's date as ISO text in UTC; null if it has none that can be read."""
    if not date:
        return None
    try:
        when = parsedate_to_datetime(date)
    except ValueError:
        return date
    return (when.astimezone(UTC) if when.tzinfo else when).replace(tzinfo=None).isoformat()


def feed_posts(feeds: DataFrame, fetch: Fetch = http_fetch, concurrency: int = 20) -> DataFrame:
    """Posts of all feeds, not deduplicated, with feed and entry position; feeds that fail give none."""

    def one(row) -> list[tuple]:
        try:
            status, body = fetch(row.feed_url)
        except Exception:  # one feed's failure is not the run's
            return []
        if status != 200:
            return []
        return [(e["url"], e["title"], row.name_, e["date"], e["categories"], entry_time(e["date"]), row.position, i) for i, e in enumerate(feed_entries(body))]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["url", "title", "source_blog", "date", "categories", "published", "feed_position", "entry_position"]
        with ThreadPoolExecutor(concurrency) as pool:
            for part in parts:
                found = [r for rows in pool.map(one, part.rename(columns={"name": "name_"}).itertuples(index=False)) for r in rows]
                yield pd.DataFrame(found, columns=names)

    ready(feeds.sparkSession)
    return feeds.select("name", "feed_url", "position").mapInPandas(run, f"{DISCOVERED.ddl}, published string, feed_position int, entry_position int")


def discover(feeds: DataFrame, start: Column | None = None, fetch: Fetch = http_fetch, concurrency: int = 20) -> DataFrame:
    """Posts of all feeds by normalised URL, the first in feed and entry order, with ids."""
    posts = feed_posts(feeds, fetch, concurrency)
    if start is not None:
        posts = keyed.since(posts, F.try_to_timestamp("published"), start)
    posts = posts.withColumn("url", tx.normalize_url(F.col("url"))).where(F.col("url") != "")
    return keyed.keep_first(posts, F.col("url"), "feed_position", "entry_position").withColumn("id", tx.url_id(F.col("url")))


def fetch_pages(posts: DataFrame, fetch: Fetch = http_fetch, concurrency: int = 10, delay: float = 1.5) -> DataFrame:
    """``posts`` with ``html``; pages that fail or are not found go. Each fetch holds its slot for ``delay`` seconds."""

    def one(url: str) -> str | None:
        try:
            status, body = fetch(url)
        except Exception:  # the page is left for the next run
            return None
        finally:
            time.sleep(delay)
        return body if status == 200 else None

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(concurrency) as pool:
            for part in parts:
                part = part.assign(html=list(pool.map(one, part["url"])))
                yield part[part["html"].notna()]

    ready(posts.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in posts.schema.fields)
    return posts.mapInPandas(run, f"{schema}, html string")


def extract_posts(pages: DataFrame, least_words: int, crawled_at: Column) -> DataFrame:
    """Posts of fetched pages: main text, metadata before the feed's, word count, long enough ones only."""
    html = F.col("html")
    rows = pages.withColumn("markdown", tx.html_text(html)).where(F.col("markdown").isNotNull())
    rows = rows.withColumn("word_count", tx.word_count(F.col("markdown"))).where(F.col("word_count") >= least_words)
    return rows.select(
        "id", "url", tx.first_filled(tx.html_title(html), F.col("title")).alias("title"), tx.html_meta(html, "author").alias("author"),
        tx.first_filled(tx.html_meta(html, "date"), F.col("date")).alias("date"), "source_blog", F.coalesce("categories", F.array().cast("array<string>")).alias("categories"),
        "markdown", "word_count", crawled_at.cast("string").alias("crawled_at"),
    )


def feeds_of(spark: SparkSession, path: str, fetch: Fetch = http_fetch) -> DataFrame:
    """The feeds of an OPML file, or of an OPML document at an http address."""
    if path.startswith(("http://", "https://")):
        status, body = fetch(path)
        if status != 200:
            raise OSError(f"{path}: HTTP status {status}")
        return opml_feeds(spark.createDataFrame([(body,)], "value string"), "value")
    return opml_feeds(spark.read.text(path, wholetext=True), "value")
