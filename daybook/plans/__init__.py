"""Step declarations and the gated runner."""

from daybook.plans.runner import GatedRunner  # noqa: F401
from daybook.plans.steps import Dataset, Step, datasets_table, specs_table  # noqa: F401
