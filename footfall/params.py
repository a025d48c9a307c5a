"""Default parameters of the analyses, as frozen dataclasses."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values that results must agree on.
BUSINESS_ZONE = "Asia/Shanghai"
RANGE_START = 1511539200  # 2017-11-25 00:00:00 in the business zone
RANGE_END = 1512316799  # 2017-12-03 23:59:59 in the business zone
RETENTION_DAYS = (1, 3, 7)
SESSION_GAP_MINUTES = 30


@dataclass(frozen=True)
class TopN:
    """How many rows each ranking keeps."""

    items: int = 50
    categories: int = 30
    converting_items: int = 50
    low_converting_items: int = 50
    category_items: int = 20
    segment_categories: int = 20
    exported_items: int = 200
    exported_categories: int = 100
    tracked_keys: int = 16384  # of a sketch that proposes frequent keys


@dataclass(frozen=True)
class ItemConversion:
    """Thresholds of the item conversion rankings."""

    min_interest: int = 10
    traffic_quantile: float = 0.8
    quantile_error: float = 0.01


@dataclass(frozen=True)
class Rfm:
    """Weights and cut points of the recency/frequency score.

    Each band is ``(upper bound inclusive, score)``; values above the last
    bound get the ``*_beyond`` score.  Segments are ``(lower bound, name)``
    from the top; everyone else is ``lowest_segment``.
    """

    recency_weight: float = 0.4
    frequency_weight: float = 0.6
    recency_bands: tuple[tuple[int, int], ...] = ((1, 5), (3, 4), (5, 3), (7, 2))
    recency_beyond: int = 1
    frequency_bands: tuple[tuple[int, int], ...] = ((1, 1), (2, 2), (4, 3), (9, 4))
    frequency_beyond: int = 5
    # The segment names.
    segments: tuple[tuple[float, str], ...] = (
        (4.0, "高价值用户"),
        (3.0, "潜力用户"),
        (2.0, "一般用户"),
        (1.4, "预流失用户"),
    )
    lowest_segment: str = "流失用户"

    @property
    def top_segment(self) -> str:
        return self.segments[0][1]


@dataclass(frozen=True)
class ActiveDays:
    """Bands of active days as (upper bound inclusive, label); the defaults fit nine days."""

    # The labels.
    bands: tuple[tuple[int, str], ...] = ((1, "仅1天"), (3, "2-3天"), (5, "4-5天"), (7, "6-7天"))
    beyond: str = "8-9天"


TOP_N = TopN()
ACTIVE_DAYS = ActiveDays()
ITEM_CONVERSION = ItemConversion()
RFM = Rfm()
