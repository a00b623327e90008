"""tidewater: purchase-order, ASN and vendor marts as Spark DataFrame jobs.

    from tidewater import Sources, asn, compliance, publish
    t = Sources.from_parquet(spark, {"transactions": ".../transactions", ...})
    publish(compliance.po_document(t, as_of), path, partition_by="expected_arrival_date",
            cluster_by="po_number")
"""

from tidewater.plans import asn, compliance, pipelines
from tidewater.session import configure
from tidewater.sources.catalog import Sources
from tidewater.sources.publish import present, publish, publish_bucketed

__all__ = ["Sources", "asn", "compliance", "configure", "pipelines", "present", "publish", "publish_bucketed"]
