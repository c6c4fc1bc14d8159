from .alerts import (  # noqa: F401
    alert_listing,
    alert_records,
    alert_rows,
    gated,
    high_gate,
    high_risk,
    medium_gate,
    medium_risk,
    pre_gate,
    severity,
    severity_counts,
)
from .features import prepare_features, window_features  # noqa: F401
from .model import (  # noqa: F401
    ModelBundle,
    assemble,
    bundle_from_tables,
    centroid_table,
    ensure_model,
    fit_kmeans,
    fit_scaler,
    load_bundle,
    model_exists,
    save_bundle,
    scaler_table,
    train,
    train_scaler,
)
from .profile import (  # noqa: F401
    check_mix_rules,
    observed_mix,
    service_gaps,
    service_level_mix,
)
from .scoring import predict, scale, scaled_vector_columns, score  # noqa: F401
