"""newsframe: news-page extraction as Spark DataFrame queries.

Raw pages ``(page_id, url, html)`` are split into a relational DOM-node table
(one row per element, pre-order numbered with subtree intervals). Every field
extractor, the body scorer, section sampling, template learning and template
application are DataFrame queries over that table.
"""

from newsframe.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
