"""Main text of HTML pages by text-to-tag ratios.

The standard library's parser streams events; block tags end lines. Every line
has its text, its number of tags, its link text and the region (sectioning
element) it stands in. The ratio of unlinked characters to tags, smoothed over
the lines by a Gaussian, splits lines at a threshold (the mean less half a
standard deviation) into a dense and a thin cluster. Regions with a dense line
are content and keep every line, short ones too; link lists stay out. Where the
page marks its article or main part, only marked parts compete: one with a dense
unlinked line is content with the short lines beside it, one without such a line
only if no line in it is mostly link (a teaser is a linked headline). Inside a
marked part a thin region of several lines, each mostly link, is a link list.
If that leaves nothing, the marked parts stay whole. Elements that are never main
text by name, role, class or id (menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles, comments) are skipped with all they hold.

Character references are decoded, white space in a line becomes one space,
lines are trimmed and joined by one newline in page order.

Scale: one map over the pages, no shuffle; a page is held on its own.

Null or empty html gives an empty text. Broken markup: a tag that never ends is text; an end tag closes what
stands open inside its element, a stray one nothing; the first article or main
part ends a block skipped for its class or id that was never closed. Repeated rows each get a row;
extra columns are kept only if named.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsignals.llm.common import ship_package

SKIPPED = frozenset("head title script style noscript template iframe object svg canvas nav footer aside form button select textarea dialog menu header".split())
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
# Class or id words of blocks that aren't main text.
SKIPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer header masthead cookie cookies consent notice gdpr popup modal overlay "
    "comment comments reply replies respond disqus related recommended share sharing social follow subscribe newsletter signup login search pagination pager toolbar widget widgets".split()
)
BLOCKS = frozenset("address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
REGIONS = frozenset("article main section div td body".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LISTS = frozenset("ul ol dl table".split())
COMMENT_WORDS = frozenset("comment comments reply replies respond disqus".split())
_word = re.compile(r"[a-z]+").findall
SIGMA = 1.0
_KERNEL = np.exp(-0.5 * (np.arange(-3, 4) / SIGMA) ** 2)
_KERNEL /= _KERNEL.sum()


class Lines(HTMLParser):
    """Collects (text, tags, link characters, region, marked part or 0) per line."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int, int]] = []
        self.open: list[tuple[str, int, int, int]] = []  # tag, skipped, marked, region; as around the element
        self.skipped, self.marked, self.region = 0, 0, 0  # skipped: 1 by class or id, 2 for certain
        self.regions, self.found, self.links = 0, False, 0
        self.data: list[str] = []
        self.tags = self.link_chars = 0

    def count_tag(self) -> None:
        """Tags of skipped blocks, and those between such a block and the last line, belong to no line."""
        if not self.skipped:
            self.tags += 1
        elif not self.data:
            self.tags = 0

    def end_line(self) -> None:
        if self.data:
            text = " ".join("".join(self.data).split())
            if text:
                self.lines.append((text, self.tags, self.link_chars, self.region, self.marked))
                self.tags = 0
            self.data = []
            self.link_chars = 0

    def handle_starttag(self, tag, attrs):
        self.count_tag()
        if tag in BLOCKS:
            self.end_line()
        if tag in VOID:
            return
        mark = tag in ("article", "main")
        skip = 2 * (tag in SKIPPED and not (tag == "header" and self.marked))
        for name, value in attrs:
            if not value or tag in ("html", "body"):
                skip = max(skip, 2 * (name == "hidden"))
            elif name == "role":
                mark |= value == "main"
                skip = max(skip, 2 * (value in SKIPPED_ROLES))
            elif name in ("class", "id") and tag != "main":
                words = SKIPPED_WORDS.intersection(_word(value.lower()))
                if words:
                    skip = max(skip, 1 if words.isdisjoint(COMMENT_WORDS) else 2)
        if mark and not skip and not self.found and self.skipped < 2:
            self.found, self.skipped = True, 0
        self.open.append((tag, self.skipped, self.marked, self.region))
        self.skipped = max(self.skipped, skip)
        if mark or tag in REGIONS or self.marked and tag in LISTS:
            self.regions += 1
            self.region = self.regions
        if mark and not self.marked:
            self.marked = self.region
        self.links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.count_tag()
        if tag in BLOCKS:
            self.end_line()

    def handle_endtag(self, tag):
        self.count_tag()
        if tag in BLOCKS:
            self.end_line()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                if any(o[0] in BLOCKS or o[1] != self.skipped for o in self.open[i:]):
                    self.end_line()
                _, self.skipped, self.marked, self.region = self.open[i]
                self.links -= sum(o[0] == "a" for o in self.open[i:])
                del self.open[i:]
                break
            if self.open[i][0] in ("article", "main", "body") and tag not in ("body", "html"):
                break

    def handle_data(self, data):
        if not self.skipped:
            self.data.append(data)
            if self.links > 0:
                self.link_chars += len(data)


def main_text(html: str) -> str:
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.end_line()
    lines = parser.lines
    if not lines:
        return ""
    size, tags, links, region = (np.array([f(x) for x in lines], float) for f in (lambda x: len(x[0]), lambda x: x[1], lambda x: x[2], lambda x: x[3]))
    ratio = np.maximum(size - links, 0) / np.maximum(tags, 1)
    smooth = np.convolve(np.pad(ratio, 3, mode="edge"), _KERNEL, mode="valid")
    limit = smooth.mean() - 0.5 * smooth.std()
    dense = smooth >= limit
    part = np.array([x[4] for x in lines])
    marked, plain = part > 0, 2 * links < np.maximum(size, 1)
    if marked.any():
        _, at = np.unique(region, return_inverse=True)
        n = np.bincount(at)
        listed = (n > 1) & (np.bincount(at, plain) == 0) & (np.bincount(at, smooth) < limit * n)
        good = np.union1d(part[marked & dense & plain], np.setdiff1d(part[marked], part[marked & ~plain]))
        keep = marked & np.isin(part, good) & ~listed[at]
        keep = keep if keep.any() else marked
    else:
        keep = np.isin(region, np.unique(region[dense & (2 * links < size)])) & (2 * links < np.maximum(size, 1))
    return "\n".join(x[0] for x, k in zip(lines, keep) if k)


def extract(pages: DataFrame, id_col="page_id", html_col="html", extra: tuple[str, ...] = ("url",)) -> DataFrame:
    """id, the columns of ``extra``, text and n_chars."""
    ship_package(pages.sparkSession)
    rows = pages.select(pages[id_col].alias(id_col), *[pages[c] for c in extra], F.coalesce(pages[html_col].cast("string"), F.lit("")).alias("__html"))
    kept = [id_col, *extra]

    def run(batches):
        for batch in batches:
            text = [main_text(x.as_py()) for x in batch.column("__html")]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], names=[*kept, "text", "n_chars"])

    return rows.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__html") + ", text string, n_chars long")
