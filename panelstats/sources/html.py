"""Cells of the tables of one HTML page."""

from __future__ import annotations

import codecs
import re
from html.parser import HTMLParser

#: The charset of pages that name none and are no UTF-8, and the most that a cell may span (what browsers take).
FALLBACK, MOST_SPANNED = "cp1256", 1000
_NAMED = re.compile(rb"""<meta[^>]{0,200}charset\s*=\s*["']?\s*([A-Za-z0-9_:.-]+)""", re.I)


class _Tables(HTMLParser):
    """Tables in the order in which they open; every cell is put at the first free column of its row, and spans are
    filled with its text; a span above MOST_SPANNED counts as that. Text belongs to the innermost open cell."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.count, self.open, self.out = 0, [], []

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.open.append({"no": self.count, "r": -1, "filled": set(), "cell": None})
            self.count += 1
        elif self.open and tag == "tr":
            self._close()
            self.open[-1]["r"] += 1
        elif self.open and tag in ("td", "th"):
            self._close()
            own, spans = self.open[-1], dict(attrs)
            own["r"] = max(own["r"], 0)
            span = lambda name: max(1, min(MOST_SPANNED, int(spans[name]))) if (spans.get(name) or "").isdigit() else 1
            own["cell"] = ([], span("rowspan"), span("colspan"))

    def handle_endtag(self, tag):
        if self.open and tag in ("td", "th", "tr"):
            self._close()
        elif self.open and tag == "table":
            self._close()
            self.open.pop()

    def handle_data(self, data):
        if self.open and self.open[-1]["cell"]:
            self.open[-1]["cell"][0].append(data)

    def _close(self):
        own = self.open[-1]
        if own["cell"]:
            (text, rows, columns), own["cell"] = own["cell"], None
            c = 0
            while (own["r"], c) in own["filled"]:
                c += 1
            said = " ".join("".join(text).split())
            for r in range(own["r"], own["r"] + rows):
                for k in range(c, c + columns):
                    if (r, k) not in own["filled"]:
                        own["filled"].add((r, k))
                        self.out.append((own["no"], r, k, said))


def decoded(page: str | bytes | None) -> str:
    """The text of a page: bytes by the charset that it names, else as UTF-8, else by FALLBACK; what no charset reads becomes a mark."""
    if page is None or isinstance(page, str):
        return page or ""
    page, named = bytes(page), []
    if found := _NAMED.search(page):
        try:
            named = [codecs.lookup(found[1].decode()).name]
        except LookupError:
            pass
    for charset in (*named, "utf-8-sig"):
        try:
            return page.decode(charset)
        except UnicodeDecodeError:
            continue
    return page.decode(FALLBACK, "replace")


def cells(text: str) -> list[tuple[int, int, int, str]]:
    """(table, row, column, text) of all cells, in order."""
    parser = _Tables()
    parser.feed(text)
    parser.close()
    while parser.open:
        parser._close()
        parser.open.pop()
    return sorted(parser.out)
