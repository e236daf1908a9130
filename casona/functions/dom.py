"""The few page fields that need element nesting: one small parser inside mapInPandas."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame


VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
FIELDS = (
    "detail_text string, seller_text string, mls_text string, data_id string, "
    "breadcrumb_links array<string>, gallery_images array<string>"
)

#: Pages whose parsed fields a Python worker holds at once.
PAGES_A_TIME = 256


class _Page(HTMLParser):
    """Collects text of the first detail, seller and MLS elements, breadcrumb links and gallery images."""

    def __init__(self, classifieds: bool):
        super().__init__(convert_charrefs=True)
        self.classifieds = classifieds
        self.open: list[tuple[str, tuple[str, ...], tuple[list, ...]]] = []  # tag, zones, texts it feeds
        self.zones: dict[str, int] = {}  # open elements per zone
        self.sinks: list[list] = []  # text buffers being filled
        self.texts: dict[str, list[str]] = {}
        self.crumbs: list[list[str]] = []
        self.images: list[str] = []
        self.data_id: str | None = None

    def handle_starttag(self, tag, attrs):
        attrs = {k: v or "" for k, v in attrs}
        css = attrs.get("class", "")
        low = css.lower()
        zones, sinks = [], []
        if attrs:
            self._note(tag, attrs)
            if "breadcrumb" in low:
                zones.append("crumbs")
            if tag == "nav" and "breadcrumb" in attrs.get("aria-label", "").lower():
                zones.append("crumb_nav")
            if "ad-view" in attrs.get("id", "").lower() or "ad-detail" in low or "listing-detail" in low:
                zones.append("ad")
            if css and {"gallery", "photo-gallery", "property-photos"} & set(css.split()):
                zones.append("gallery")
            if any(w in low for w in ("agent", "seller", "contact")):
                self._first("seller", sinks)
            if "data-mls-id" in attrs or "mls" in css:
                self._first("mls", sinks)
        if tag == "picture":
            zones.append("gallery")
        if self._is_detail(tag, css, low):
            self._first("detail", sinks)
        in_crumbs = self.zones.get("crumbs") and (not self.classifieds or self.zones.get("ad"))
        if (tag == "a" and in_crumbs) or (tag == "li" and self.zones.get("crumb_nav") and not self.classifieds):
            self.crumbs.append([])
            sinks.append(self.crumbs[-1])
        if tag not in VOID:
            for z in zones:
                self.zones[z] = self.zones.get(z, 0) + 1
            self.sinks.extend(sinks)
            self.open.append((tag, tuple(zones), tuple(sinks)))

    def _is_detail(self, tag, css, low):
        if self.classifieds:
            return tag == "main" or "detail" in css or "listing" in css
        return tag in ("main", "article") or "property" in low or "listing" in low

    def _first(self, role, sinks):
        if role not in self.texts:
            self.texts[role] = []
            sinks.append(self.texts[role])

    def _note(self, tag, attrs):
        if self.data_id is None:
            self.data_id = attrs.get("data-listing-id") or attrs.get("data-mls-id") or None
        if (tag == "img" and self.zones.get("gallery")) or "data-src" in attrs:
            src = attrs.get("src") or attrs.get("data-src") or attrs.get("data-original")
            if src:
                self.images.append(src)

    def handle_endtag(self, tag):
        if not any(name == tag for name, _, _ in reversed(self.open)):
            return
        while self.open:
            name, zones, sinks = self.open.pop()
            for z in zones:
                self.zones[z] -= 1
            for sink in sinks:
                self.sinks = [s for s in self.sinks if s is not sink]
            if name == tag:
                return

    def handle_data(self, data):
        for sink in self.sinks:
            sink.append(data)

    def text(self, role: str) -> str | None:
        return "".join(self.texts[role]).strip() if role in self.texts else None


def _parse(html: str, classifieds: bool, detail_chars: int | None, seller_chars: int | None) -> dict:
    page = _Page(classifieds)
    page.feed(html or "")
    page.close()
    crumbs = [" ".join("".join(c).split()) for c in page.crumbs]
    seller = page.text("seller")
    return {
        "detail_text": (page.text("detail") or "")[:detail_chars],
        "seller_text": (seller or "")[:seller_chars] or None,
        "mls_text": page.text("mls") or None,
        "data_id": page.data_id,
        "breadcrumb_links": list(dict.fromkeys(c for c in crumbs if c)),
        "gallery_images": page.images,
    }


def dom_fields(
    pages: DataFrame, keys: list[str], classifieds: str | None = None, detail_chars: int | None = None,
    seller_chars: int | None = None,
) -> DataFrame:
    """``keys`` plus the nested-element fields of each page, in the pages' own partitions.

    ``classifieds`` names a boolean column choosing the classified-ad selectors. Only keys and
    html travel to the Python workers, in Arrow batches. Texts are whole unless a number of
    characters is given.
    """
    carried = keys if "html" in keys else [*keys, "html"]
    picked = pages.selectExpr(*carried, f"{classifieds or 'false'} AS _classifieds")
    types = dict(pages.dtypes)
    schema = ", ".join(f"`{k}` {types[k]}" for k in keys) + ", " + FIELDS

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), PAGES_A_TIME):
                part = batch.iloc[start:start + PAGES_A_TIME]
                rows = [_parse(h, bool(c), detail_chars, seller_chars) for h, c in zip(part["html"], part["_classifieds"])]
                found = pd.DataFrame(rows, index=part.index, columns=[f.split()[0] for f in FIELDS.split(", ")])
                yield pd.concat([part[keys], found], axis=1)

    return picked.mapInPandas(run, schema)
