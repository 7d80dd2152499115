"""estuary: a PySpark engine for fisheries-independent survey data.

Selects survey hauls, standardises gear and effort, summarises water
chemistry and habitat per haul, expands sub-sampled catch counts, builds
length frequencies, combines everything at haul x species grain and
produces data-quality and enrichment tables.  Every operator is a plain
DataFrame -> DataFrame (or Column -> Column) function built on Spark's
built-in expressions, so Catalyst sees the whole plan.
"""

from estuary.config import ALL_HAULS, DEFAULT, SurveyConfig

__all__ = ["SurveyConfig", "DEFAULT", "ALL_HAULS"]
