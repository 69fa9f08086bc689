"""Entity and job parameters (one definition shared by every step)."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that must equal the reference's for matching results:
# the threshold grid of the analysis sweep, the neighbour count and the
# separator of the combined text.
DEFAULT_THRESHOLDS: tuple[float, ...] = (
    0.99, 0.98, 0.97, 0.96, 0.95, 0.94, 0.93, 0.92, 0.91, 0.90, 0.85, 0.80, 0.75,
)
DEFAULT_NUM_RESULTS = 3
COMBINED_SEPARATOR = ","
COMBINED_COLUMN = "combined_data"
HIGH_SCORE_CUTOFF = 0.99  # strict ">" in the pair statistic
PERFECT_SCORE = 1.0

METHODS = ("exact", "dense", "hybrid", "lsh", "minhash")
TEXT_MODES = ("shingles", "tokens", "words")


@dataclass(frozen=True)
class EntitySpec:
    """One table to deduplicate.

    ``table`` is a catalog name (``schema.table``) or a parquet path;
    ``exclude`` is a real list of column names (never a substring test);
    ``threshold`` None means: analysed, but never deduplicated.
    """

    table: str
    primary_key: str
    exclude: tuple[str, ...] = ()
    threshold: float | None = None
    text_mode: str = "shingles"  # one of TEXT_MODES
    vector_column: str | None = None

    def __post_init__(self):
        if not self.table or not self.primary_key:
            raise ValueError("table and primary_key are required")
        if self.text_mode not in TEXT_MODES:
            raise ValueError(f"text_mode must be one of {TEXT_MODES}")
        object.__setattr__(self, "exclude", tuple(self.exclude))
        if self.threshold is not None:
            t = float(self.threshold)
            if not 0.0 <= t <= 1.0:
                raise ValueError(f"threshold {t} outside [0, 1]")
            object.__setattr__(self, "threshold", t)

    @property
    def entity_name(self) -> str:
        """Last part of a dotted table name or of a path, without suffix."""
        last = self.table.rstrip("/").replace("\\", "/").split("/")[-1].split(".")
        if self.table.endswith(".parquet") and len(last) > 1:
            return last[-2]
        return last[-1]


@dataclass(frozen=True)
class JobParams:
    """Validated job parameters (catalog, k, scoring method, thresholds)."""

    catalog: str
    num_results: int = DEFAULT_NUM_RESULTS
    method: str = "hybrid"
    embedding_model: str = "hashed-char-ngrams"
    thresholds: tuple[float, ...] = field(default=DEFAULT_THRESHOLDS)
    entities: tuple[EntitySpec, ...] = ()
    drop_candidates_after_dedupe: bool = False

    def __post_init__(self):
        if not self.catalog or not str(self.catalog).strip():
            raise ValueError("catalog is required")
        k = int(self.num_results)
        if k < 1:
            raise ValueError("num_results must be >= 1")
        object.__setattr__(self, "num_results", k)
        if self.method not in METHODS:
            raise ValueError(f"method must be one of {METHODS}")
        ts = tuple(float(t) for t in self.thresholds)
        if not ts or any(not 0.0 <= t <= 1.0 for t in ts):
            raise ValueError("thresholds must be a non-empty list within [0, 1]")
        object.__setattr__(self, "thresholds", ts)
        object.__setattr__(self, "entities", tuple(self.entities))
