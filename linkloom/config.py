"""Options of the linkage pipeline; nothing is read or created on import."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Options:
    block_cap: int | None = 800  #: largest block, in candidate rows, that a key may have; None: any
    top_k: int = 25  #: neighbours of a record
    vocabulary: int | None = 30_000  #: grams of a country that the neighbour search weighs; None: all
    pair_cap: int | None = None  #: candidate pairs kept, in order of their ids; None: all
    threshold: float = 0.90  #: least score of a match
    margin: float = 0.10  #: least lead of a sole match over the next candidate
    slack: float = 0.05  #: a sole match this far above the threshold needs no lead
    rounds: int = 500  #: boosting rounds
    step: float = 0.05
    depth: int = 7
    per_country: int | None = 300_000  #: training candidates of a country besides its positives; None: all
    country_sample: int | None = None  #: candidates of a country that the neighbour search looks at, the first in hash order; None: all
    seed: int = 42
