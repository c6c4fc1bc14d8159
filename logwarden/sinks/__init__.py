from .alert_store import compact_alerts, empty_alerts, insert_alerts, read_alerts  # noqa: F401
from .snapshot import read_snapshot, snapshot_logs  # noqa: F401
from .topic import (  # noqa: F401
    alert_publisher,
    alerts_to_records,
    decode_alert_records,
    publish_records,
)
