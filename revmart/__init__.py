"""revmart: a Spark-native finance & sales analytics warehouse.

Layers (all lazy DataFrames): raw sources -> staging -> dimensions and
marts -> presentation relations. Typical use::

    from revmart import Warehouse, build_session, land
    spark = build_session("local[8]")
    land(spark, "/data/extracts", database="raw")
    w = Warehouse.from_tables(spark, "raw")
    w["vw_exec_kpi_scorecard"].show()
    w.materialize("analytics", presentation_database="presentation")
"""

from revmart.plans.warehouse import RELATIONS, Warehouse, register_views
from revmart.session import build_session
from revmart.sources.landing import land
from revmart.sources.raw import Sources

__version__ = "0.1.0"

__all__ = ["RELATIONS", "Sources", "Warehouse", "build_session", "land", "register_views"]
