"""Tags of a page by one forward scan, in time that grows with the page however broken it is.

What is no tag (a '<' without a tag's name, a tag whose quotes or itself never
close) is text. A comment or CDATA section that never closes lasts to the end.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

_SPECIAL = re.compile(r"[>\"']")
_NAME = re.compile(r"/?[a-zA-Z]")
_STOP = re.compile(r"[\s/>]")


class Markup:
    """The tags of one page. A consumer may move ``at`` forward, past the content of an element."""

    def __init__(self, page: str):
        self.page, self.at = page, 0
        self.special = [m.start() for m in _SPECIAL.finditer(page)]
        # for each quote the place after the next one of its kind, in the list of special characters
        self.after, later = [0] * len(self.special), {}
        for i in range(len(self.special) - 1, -1, -1):
            sign = page[self.special[i]]
            self.after[i] = later.get(sign, 0)
            later[sign] = i + 1
        self.dead: set[int] = set()          # places from which no tag ends
        self.stop = (0, -1)                  # where the last tag's name was looked for, and its end
        self.open_ended: set[str] = set()    # elements and signs that close nowhere further on

    def _find(self, what: str, at: int) -> int:
        """Where the page goes on after ``what``; its end if it is nowhere further on."""
        if what not in self.open_ended:
            found = self.page.find(what, at)
            if found >= 0:
                return found + len(what)
            self.open_ended.add(what)
        return len(self.page)

    def _name_end(self, at: int) -> int:
        if not self.stop[0] <= at <= self.stop[1]:
            m = _STOP.search(self.page, at)
            self.stop = at, m.start() if m else len(self.page)
        return self.stop[1]

    def _tag_end(self, at: int) -> int:
        """The end of a tag whose attributes begin at ``at``, -1 without one."""
        i, seen = bisect_left(self.special, at), []
        while i < len(self.special) and i not in self.dead:
            if self.page[self.special[i]] == ">":
                return self.special[i] + 1
            seen.append(i)
            if not self.after[i]:
                break
            i = self.after[i]
        self.dead.update(seen)
        return -1

    def close(self, name: str, at: int) -> tuple[int, int]:
        """(start, end) of the next end tag of ``name``; (-1, -1) without one."""
        if name not in self.open_ended:
            m = re.compile(rf"</{re.escape(name)}\b", re.I).search(self.page, at)
            end = self.page.find(">", m.end()) + 1 if m else 0
            if end:
                return m.start(), end
            self.open_ended.add(name)
        return -1, -1

    def tags(self) -> Iterator[tuple[int, int, bool, str, str]]:
        """(start, end, is an end tag, lower-case name, attributes) one by one; comments and declarations have no name."""
        page = self.page
        while (start := page.find("<", self.at)) >= 0:
            if page.startswith("<!--", start):
                self.at = self._find("-->", start + 4)
                yield start, self.at, False, "", ""
            elif page.startswith("<![CDATA[", start):
                self.at = self._find("]]>", start + 9)
                yield start, self.at, False, "", ""
            elif page.startswith(("<!", "<?"), start):
                self.at = self._find(">", start + 2)
                yield start, self.at, False, "", ""
            elif _NAME.match(page, start + 1) and (end := self._tag_end(stop := self._name_end(start + 2))) >= 0:
                closes = page[start + 1] == "/"
                self.at = end
                yield start, end, closes, page[start + 1 + closes:stop].lower(), page[stop:end - 1]
            else:
                self.at = start + 1
