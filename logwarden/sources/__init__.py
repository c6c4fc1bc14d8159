from .codec import (  # noqa: F401
    classify_records,
    decode_logs,
    encode_logs,
    parse_log,
    split_malformed,
    value_text,
)
from .fixtures import events_to_logs, load_logs, read_events  # noqa: F401
from .topic import read_topic, read_topic_stream  # noqa: F401
