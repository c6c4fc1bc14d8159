"""A stored model as literal tables, used by the SQL-checked scoring queries.

k-means itself cannot be re-run in SQL, so the checked queries score against
this fixed model (scaler statistics and centroids, 6-hour windows, clusters in
error-rate order) while still reading the whole log table. The numbers are a
fit on the sf0.01 test data rounded to 6 decimals.
"""

from __future__ import annotations

from ..operators.model import ModelBundle

FIXED_WINDOW = "6 hours"

# --- fixed values: model table (vector order total_logs, error_count,
# error_rate, avg_message_length) -------------------------------------------
FIXED_MEANS = [27.777778, 5.594444, 20.213528, 15.496737]
FIXED_STDS = [5.108904, 2.264408, 7.563722, 0.278801]
FIXED_CENTERS = [
    [-0.574021, -0.801004, -0.632857, 0.342169],
    [1.135502, 0.206992, -0.284774, 0.026577],
    [-0.171813, 0.949921, 1.137694, -0.505099],
]
# --- end of fixed values ----------------------------------------------------


def fixed_bundle() -> ModelBundle:
    return ModelBundle(window=FIXED_WINDOW, means=list(FIXED_MEANS),
                       stds=list(FIXED_STDS),
                       centers=[list(c) for c in FIXED_CENTERS],
                       fit_ids=list(range(len(FIXED_CENTERS))))
