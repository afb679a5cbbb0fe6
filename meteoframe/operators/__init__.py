"""DataFrame -> DataFrame operators (dedupe, joins, pivot, merge, grids, quality)."""

from meteoframe.operators.dedupe import pick_one, keep_first  # noqa: F401
from meteoframe.operators.joins import join_dimension  # noqa: F401
from meteoframe.operators.reshape import duplicate_keys, pivot_checked  # noqa: F401
from meteoframe.operators.merge import dedupe_source, upsert_frame, replace_range, retain  # noqa: F401
from meteoframe.operators.grids import day_stamps, expand_grid, month_days  # noqa: F401
from meteoframe.operators.batches import drop_bad_batches, observe_counts, union_all  # noqa: F401
from meteoframe.operators import quality  # noqa: F401
