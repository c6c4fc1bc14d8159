"""Fixed values that must equal the original application's for equal results.

They are stated plainly and together here; the rest of the library refers to
these names only.
"""

# --- fixed values -----------------------------------------------------------
LOGS_TOPIC = "logs-topic"
ALERTS_TOPIC = "alerts"

LEVEL_INFO = "INFO"
LEVEL_WARN = "WARN"
LEVEL_ERROR = "ERROR"

WIRE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"   # log and alert records

SERVICE_NAMES = ["order-service", "cart-service", "product-service"]

DETECTION_WINDOW = "15 minutes"      # streaming window and watermark delay
TRAINING_WINDOW = "5 minutes"        # window of the original training job
TRIGGER_INTERVAL = "15 seconds"

KMEANS_K = 3
KMEANS_MAX_ITER = 50
KMEANS_SEED = 1

MEDIUM_CLUSTER = 1
MEDIUM_MIN_ERROR_RATE = 5.0          # strictly greater than
HIGH_CLUSTER = 2
HIGH_MIN_ERROR_RATE = 15.0           # strictly greater than
MIN_TOTAL_LOGS = 10                  # strictly greater than

SEVERITY_HIGH = "HIGH"
SEVERITY_MEDIUM = "MEDIUM"
SEVERITY_LOW = "LOW"

ALERT_TYPE = "HIGH_ERROR_RATE"
ALERT_SOURCE = "anomaly-detector"
ALERT_DESCRIPTION_FORMAT = "%s servisinde hata oranı: %.2f%%"
ALERT_TIME_DISPLAY_FORMAT = "dd.MM.yyyy HH:mm:ss"

TARGET_INFO_RATE = 70
TARGET_WARN_RATE = 20
TARGET_ERROR_RATE = 10
TARGET_DELAY_MS = 200
MIN_DELAY_MS = 1
MIX_TOTAL = 100
# --- end of fixed values ----------------------------------------------------
