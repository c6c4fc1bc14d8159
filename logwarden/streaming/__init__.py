from .detector import (  # noqa: F401
    DEFAULT_TRIGGER,
    alert_batch_handler,
    changelog_writer,
    checkpoint_location,
    current_features,
    fold_changelog,
    latest_features,
    logs_from_event_files,
    logs_from_records,
    run_until_idle,
    scored_stream,
    start_detection,
    start_feature_changelog,
    start_feature_table,
    stream_features,
)
