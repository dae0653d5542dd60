"""What a run is asked to do: one frozen record, filled from a named mode and checked on the driver."""

from __future__ import annotations

from dataclasses import asdict, dataclass, replace

#: mode: (documents kept, rows scanned or None for all, dedup backend, loader)
MODES: dict[str, tuple[int, int | None, str, str]] = {
    "smoke": (2_000, 50_000, "memory", "datasets"),
    "development": (20_000, 500_000, "memory", "datasets"),
    "final": (50_000, None, "memory", "datasets"),
    "release-400k": (400_000, None, "sqlite", "shards"),
}
ALIASES = {"dev": "development", "devtest": "development"}
LOADERS = ("datasets", "shards")
#: Both names stand for the same distributed operator here, as its state spills to disk by itself.
DEDUP_BACKENDS = ("memory", "sqlite")

CLEANING_REASONS = ("empty_text", "invalid_text", "too_short", "too_long")
RULE_REASONS = ("encoding_corruption", "binary_or_invalid_content", "foreign_script_dominant", "concatenated_dump")
DUPLICATE_REASONS = ("duplicate_id", "duplicate_text")
#: Every reason a document can be turned away for.
REASONS = CLEANING_REASONS + RULE_REASONS + DUPLICATE_REASONS
SPLITS = ("train", "validation", "test")


@dataclass(frozen=True)
class Thresholds:
    replacement_chars: int = 3
    unusual_count: int = 8
    unusual_ratio: float = 0.005
    non_latin_share: float = 0.3
    line_length: int = 20_000


@dataclass(frozen=True)
class Policy:
    """Which of the four rules reject; the others are only reported."""

    encoding_corruption: bool = True
    binary_or_invalid_content: bool = True
    foreign_script_dominant: bool = False
    concatenated_dump: bool = False

    def enabled(self) -> tuple[str, ...]:
        return tuple(r for r in RULE_REASONS if getattr(self, r))


@dataclass(frozen=True)
class Settings:
    source: str = ""
    revision: str | None = None
    source_split: str = "train"
    streaming: bool = True
    mode: str = "smoke"
    max_documents: int | None = None  # from the mode
    scan_limit: int | None = None  # from the mode; 0: no limit
    seed: int = 42
    min_chars: int = 20
    max_chars: int | None = None
    train_ratio: float = 0.90
    val_ratio: float = 0.05
    output_dir: str = "data"
    overwrite: bool = False
    sample_size: int = 10
    text_field: str = "text"
    id_field: str = "id"
    domain_field: str = "domain"
    audit_dir: str = "audit"
    review_dir: str = "review"
    near_duplicates: bool = False
    simhash_threshold: int = 3
    shingle_size: int = 4
    subset: int = 0  # audit only so many documents; 0: all
    dedup_backend: str | None = None
    loader: str | None = None
    rejected_sample_size: int = 20
    policy: Policy = Policy()
    thresholds: Thresholds = Thresholds()
    compat_percentiles: bool = False

    def resolved(self) -> Settings:
        """With what the mode says, where nothing else was asked for."""
        mode = ALIASES.get(self.mode, self.mode)
        if mode not in MODES:
            raise ValueError(f"no mode {self.mode!r}; there are {', '.join(sorted(MODES))}")
        documents, scan, backend, loader = MODES[mode]
        limit = None if self.scan_limit == 0 else scan if self.scan_limit is None else self.scan_limit
        return replace(self, mode=mode, max_documents=self.max_documents or documents, scan_limit=limit, dedup_backend=self.dedup_backend or backend, loader=self.loader or loader)

    def checked(self) -> Settings:
        problems = [
            (self.max_documents is None or self.max_documents <= 0, "max_documents must be 1 at least"),
            (self.min_chars < 0, "min_chars can't be negative"),
            (self.max_chars is not None and self.max_chars < self.min_chars, "max_chars can't be less than min_chars"),
            (self.train_ratio <= 0 or self.val_ratio < 0, "ratios of splits must be positive"),
            (self.train_ratio + self.val_ratio >= 1.0, "train and validation must leave a share for test"),
            (self.dedup_backend not in DEDUP_BACKENDS, f"dedup_backend is one of {', '.join(DEDUP_BACKENDS)}"),
            (self.loader not in LOADERS, f"loader is one of {', '.join(LOADERS)}"),
        ]
        for wrong, what in problems:
            if wrong:
                raise ValueError(what)
        return self

    def effective(self) -> dict:
        return asdict(self)
