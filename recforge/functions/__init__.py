"""Column expressions (no Python row functions): scalar parsing and
formatting, array ranking, vector arithmetic and integer hashing."""

from recforge.functions.scalar import (  # noqa: F401
    clean_title,
    fmt2,
    label,
    release_year,
    split_part,
)
from recforge.functions.arrays import first_n, rank_by_frequency, sort_by_keys  # noqa: F401
from recforge.functions.vectors import cosine, dot, fm_pairwise, sq_euclidean  # noqa: F401
from recforge.functions.hashing import draw, share, uniform_excluding  # noqa: F401
