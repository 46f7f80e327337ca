"""SQL access: base tables, reporting views and the element function by name."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from quaywork.operators import reports

# SQL names of the base tables.
TABLE_NAMES = {
    "files": "EDI940_Raw",
    "headers": "EDI940_Header",
    "addresses": "EDI940_Address",
    "details": "EDI940_Detail",
    "controls": "EDI940_Control",
    "wms_orders": "OrderHeader_Staging",
    "wms_lines": "OrderDetail_Staging",
    "wms_events": "OrderIntegrationLog",
    "proc_log": "EDI940_ProcessingLog",
    "run_log": "EDI940_PipelineLog",
    "load_log": "PipelineLoadLog",
    "customer_orders": "CustomerOrders",
    "customer_orders_staging": "CustomerOrders_Staging",
    "aliases": "CustomerAliases",
    "error_kb": "ErrorKnowledgeBase",
    "feedback": "ChatFeedback",
}


def register_views(
    spark: SparkSession, tables: dict[str, DataFrame], as_of: datetime | None = None
) -> list[str]:
    """Temporary views over the given tables; a report appears once its tables are there."""
    views = {TABLE_NAMES[name]: df for name, df in tables.items()}

    def add(name: str, needs: tuple[str, ...], build) -> None:
        if all(n in tables for n in needs):
            views[name] = build(*[tables[n] for n in needs])

    add(
        "vw_FileReconciliation",
        ("files", "headers", "wms_orders"),
        lambda f, h, o: reports.file_reconciliation(f, h, o, as_of),
    )
    add(
        "vw_PiplineFunnel",
        ("files", "wms_orders"),
        lambda f, o: reports.pipeline_funnel(f, o, as_of),
    )
    add("vw_EDI940_CurrentStatus", ("proc_log",), lambda p: reports.current_status(p, as_of))
    add(
        "vw_EDI940_FilesNeedingAttention",
        ("proc_log",),
        lambda p: reports.files_needing_attention(p, as_of),
    )
    add("v_RecentLoadActivity", ("load_log",), reports.recent_loads)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    spark.sql(
        r"""CREATE OR REPLACE TEMPORARY FUNCTION GetEDIElement(segment STRING, position INT)
            RETURNS STRING
            RETURN nullif(trim(get(split(coalesce(segment, ''), '\\*', -1), position)), '')"""
    )
    return sorted(views)
