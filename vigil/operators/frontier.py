"""Link classification and crawl-frontier expansion over landed pages.

The frontier is the set of followable link targets that were not visited
yet: a ``left_anti`` join against the visited set. The multi-round form runs
one job per round from the driver loop (never a row loop) until nothing is new
and checkpoints what each round adds, so lineage stays short and a lost
executor only recomputes one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.arrays import breadcrumb_dirs, path_join
from vigil.functions.text import extract_between, normalize_file_name
from vigil.session import ensure_checkpoint_dir
from vigil.functions.urls import normalize_url, resolve
from vigil.sources.pages import base_ref, hrefs


def classify_links(links: DataFrame, follow: str, download: str, href: str = "href") -> DataFrame:
    """Flag links to follow / to download by substring (both may hold)."""
    return (links.withColumn("to_follow", F.col(href).contains(follow))
                 .withColumn("to_download", F.col(href).contains(download)))


def link_targets(pages: DataFrame, follow: str | None = None) -> DataFrame:
    """(source page url, absolute target url) for every anchor, or for those
    whose href contains ``follow``; both URLs in one spelling, so that each page
    has one name however it is linked. Pages without a url have no targets."""
    found = hrefs("html")
    if follow is not None:
        found = F.filter(found, lambda h: h.contains(follow))
    links = pages.where(F.col("url").isNotNull()).select("url", base_ref("html").alias("_base"), found.alias("_hrefs")) \
        .select(normalize_url("url").alias("source_url"), resolve("_base", "url").alias("_at"), F.explode("_hrefs").alias("href"))
    return links.select("source_url", resolve("href", "_at").alias("target_url"))


def frontier(pages: DataFrame, visited: DataFrame, follow: str | None = None) -> DataFrame:
    """Distinct link targets of ``pages`` not in ``visited`` (column ``url``)."""
    t = link_targets(pages, follow).select(F.col("target_url").alias("url")).distinct()
    v = visited.select(normalize_url("url").alias("url")).distinct()
    return t.join(v, "url", "left_anti")


def expand_frontier(pages: DataFrame, seeds: DataFrame, follow: str | None = None, depth: int | None = None) -> DataFrame:
    """Breadth-first crawl over a landed page table: (url, round) of every url
    reached from ``seeds`` (column ``url``), until a round finds nothing new.

    ``follow`` keeps the crawl to links whose href contains it. With ``depth``
    the crawl stops after so many rounds; the rows of round ``depth`` are then
    the frontier that was not expanded. Pages are read once, into an edge table;
    a round joins the last round's urls to the edges and checkpoints what is new.
    Both joins are shuffled at every size: broadcast, the urls of every round would
    stay in the driver's memory until the crawl ends.
    """
    ensure_checkpoint_dir(pages.sparkSession)
    edges = link_targets(pages, follow).distinct().checkpoint()
    new = (seeds.select(normalize_url("url").alias("url")).distinct()
           .withColumn("round", F.lit(0)).checkpoint())
    reached, r = new, 0
    while depth is None or r < depth:
        r += 1
        new = (edges.join(new.select(F.col("url").alias("source_url")).hint("merge"), "source_url")
               .select(F.col("target_url").alias("url")).distinct()
               .join(reached.select("url").hint("merge"), "url", "left_anti")
               .withColumn("round", F.lit(r)).checkpoint())
        if new.isEmpty():
            break
        reached = reached.unionByName(new)
        if r % 10 == 0:  # keeps the union short in deep crawls
            reached = reached.checkpoint()
    return reached


def manifest_rows(pages: DataFrame, crumbs: str, links: str, crawl_time, root: str = "data",
                  download: str = "json.txt", url: str = "url") -> DataFrame:
    """Crawl-manifest rows (crawl_time, file_path, parent_url, file_url) for
    the download links of each page: the page's breadcrumb texts give the
    directory (slugged, home entry and trailing number removed), each link's
    ``fich=`` marker gives the file name. ``crawl_time`` is a Column (inject a
    literal for reproducible runs). Links without the marker are not rows of a
    manifest; ``unnamed_links`` lists them."""
    directory = path_join(breadcrumb_dirs(crumbs))
    rows = (pages.select(F.col(url).alias("parent_url"), directory.alias("_dir"),
                         F.explode(F.filter(links, lambda h: h.contains(download))).alias("file_url")))
    name = normalize_file_name(extract_between("file_url", "fich=", "&Inline=true"))
    return rows.where(name.isNotNull()).select(crawl_time.alias("crawl_time"),
                       F.concat_ws("/", F.lit(root), F.col("_dir"), name).alias("file_path"),
                       "parent_url", "file_url")


def unnamed_links(pages: DataFrame, links: str, download: str = "json.txt", url: str = "url") -> DataFrame:
    """Quarantine of ``manifest_rows``: download links that lack the file-name
    markers (parent_url, file_url, error_reason)."""
    rows = pages.select(F.col(url).alias("parent_url"), F.explode(F.filter(links, lambda h: h.contains(download))).alias("file_url"))
    return rows.where(extract_between("file_url", "fich=", "&Inline=true").isNull()) \
        .withColumn("error_reason", F.lit("no file name marker"))
