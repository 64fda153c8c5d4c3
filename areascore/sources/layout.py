"""Where the stages keep their tables."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    """Paths below one root, which may be any URI that Hadoop file systems resolve.

    ``raw`` may live elsewhere: clusters often keep the feeds in a folder of another name.
    """

    root: str
    raw_root: str | None = None

    def _under(self, folder: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{folder}/{name}"

    def raw(self, name: str) -> str:
        if self.raw_root:
            return f"{self.raw_root.rstrip('/')}/{name}"
        return self._under("raw", name)

    def cleaned(self, name: str) -> str:
        return self._under("cleaned", name)

    def enriched(self, name: str) -> str:
        return self._under("enriched", name)

    def geo(self, name: str) -> str:
        return self._under("geo", name)

    def scores(self, name: str) -> str:
        return self._under("scores", name)

    def analytics(self, name: str) -> str:
        return self._under("analytics", name)
