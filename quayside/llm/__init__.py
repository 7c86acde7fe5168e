"""Operators for preparing training data: each module holds one operator, its query and, where there is one, its SQL."""

from __future__ import annotations

from quayside.llm.common import QUERIES, SQL


def load_all() -> None:
    from quayside.llm import (  # noqa: F401
        ann,
        bpe,
        chat,
        jaccard,
        licenses,
        lines,
        mixing,
        negatives,
        pages,
        runs,
        search,
        store,
        toxicity,
    )


__all__ = ["QUERIES", "SQL", "load_all"]
