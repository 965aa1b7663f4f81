"""One frozen parameter object shared by every operator.

All date bounds are resolved here, on the driver, as plain ``date`` values so
that every scan filter is a literal that reaches the Parquet reader.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

OPS = ("AVG", "STDDEV", "MIN", "MAX")


@dataclass(frozen=True)
class DemandConfig:
    """Horizon, splits, windows and key names of a forecasting run."""

    end: date = date(2023, 3, 1)
    horizon: int = 28
    train_days: int = 545
    valid_days: int = 14
    test_days: int = 7
    ops: tuple[str, ...] = OPS
    category_ops: tuple[str, ...] = ("AVG", "STDDEV")
    windows: tuple[int, ...] = (365, 180, 90, 60, 30)
    lags: tuple[int, ...] = (1, 2, 3, 4, 5, 6, 7, 14, 21, 28)
    max_last_days: int = 200
    interval_days: int = 180
    min_support: int = 10
    scale_support: bool = True
    head_days: int = 30
    tail_days: int = 200
    stats_days: tuple[int, ...] = ()
    stats_delay: int = 7
    abc_days: int = 90
    sample_rate: int = 5

    item: str = "yj_code"
    location: str = "store_code"
    day: str = "dispensing_date"
    subject: str = "patient_no"

    def __post_init__(self) -> None:
        for op in (*self.ops, *self.category_ops):
            if op not in OPS:
                raise ValueError(f"unsupported aggregate {op!r}; choose from {OPS}")
        if self.horizon < 1 or min(self.windows) < 1 or min(self.lags) < 0:
            raise ValueError("horizon and windows must be positive, lags non-negative")
        if self.sample_rate < 1:
            raise ValueError("sample_rate must be at least 1")

    @classmethod
    def from_timestamp(cls, end_ts: str, tz: str = "Asia/Tokyo", **kw) -> "DemandConfig":
        """Resolve an ISO timestamp to the local calendar day in ``tz``."""
        ts = datetime.fromisoformat(end_ts)
        if ts.tzinfo is None:
            ts = ts.replace(tzinfo=ZoneInfo("UTC"))
        return cls(end=ts.astimezone(ZoneInfo(tz)).date(), **kw)

    def with_(self, **kw) -> "DemandConfig":
        return replace(self, **kw)

    # -- keys ---------------------------------------------------------------
    @property
    def pair(self) -> list[str]:
        return [self.item, self.location]

    @property
    def keys(self) -> list[str]:
        return [self.item, self.location, self.day]

    @property
    def triple(self) -> list[str]:
        return [self.subject, self.item, self.location]

    # -- spans --------------------------------------------------------------
    def _back(self, base: date, n: int) -> date:
        return base - timedelta(days=n)

    @property
    def split_days(self) -> int:
        return self.train_days + self.valid_days + self.test_days

    @property
    def panel_start(self) -> date:
        """First day of the facts, the panel and the subject panel."""
        return self._back(self.end, self.split_days + 3 * self.horizon - 1 + max(self.windows))

    @property
    def panel_end(self) -> date:
        """Exclusive: the first day whose forward horizon is incomplete."""
        return self._back(self.end, self.horizon - 1)

    @property
    def feature_start(self) -> date:
        return self._back(self.panel_end, self.split_days + 2 * self.horizon)

    @property
    def history_start(self) -> date:
        """First panel day a trailing window of any feature can reach."""
        return self._back(self.feature_start, self.horizon + max(self.windows))

    @property
    def recency_start(self) -> date:
        return self._back(self.feature_start, self.max_last_days)

    @property
    def dataset_end(self) -> date:
        """Inclusive last day of the train dataset; also the prediction base day."""
        return self._back(self.end, self.horizon)

    @property
    def train_start(self) -> date:
        return self._back(self.dataset_end, self.split_days + 2 * self.horizon)

    @property
    def train_end(self) -> date:
        return self._back(self.dataset_end, self.valid_days + self.test_days + 2 * self.horizon)

    @property
    def valid_start(self) -> date:
        return self._back(self.dataset_end, self.valid_days + self.test_days + self.horizon)

    @property
    def valid_end(self) -> date:
        return self._back(self.dataset_end, self.test_days + self.horizon)

    @property
    def test_start(self) -> date:
        return self._back(self.dataset_end, self.test_days)

    @property
    def prescriber_start(self) -> date:
        return self._back(self.panel_end, self.split_days + 2 * self.horizon)

    @property
    def prescriber_end(self) -> date:
        return self._back(self.panel_end, self.valid_days + self.test_days + 2 * self.horizon)

    @property
    def abc_start(self) -> date:
        return self._back(self.dataset_end, self.test_days)

    @property
    def base_day(self) -> date:
        """Last complete panel day: predictions start from here."""
        return self._back(self.panel_end, 1)


# Experiment presets: fixed values of the published experiment files.
EXPERIMENTS = {
    "exp001": dict(label="log", subject=False, test_days=56),
    "exp002": dict(label="log", subject=True, test_days=56),
    "exp003": dict(label="log", subject=True, test_days=56, train_days=211, windows=(180, 90, 60, 30)),
    "exp004": dict(label="diff", subject=False, test_days=56),
    "exp005": dict(label="raw", subject=False, test_days=56),
    "exp006": dict(label="diff", subject=True, test_days=56),
    "exp042": dict(label="log", subject=False),
    "exp046": dict(label="scaled", subject=False),
    "exp047": dict(label="diff", subject=False),
}


def experiment(name: str, **overrides) -> tuple[DemandConfig, str, bool]:
    """``(config, label kind, use subject features)`` of a named experiment."""
    preset = dict(EXPERIMENTS[name])
    label, subject = preset.pop("label"), preset.pop("subject")
    return DemandConfig(**{**preset, **overrides}), label, subject
