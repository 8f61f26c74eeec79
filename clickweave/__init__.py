"""clickweave: a Spark-native engine for click-log features and scoring.

Impression, view-log and item tables go in as DataFrames; per-user lag and
lead gaps, their statistics, counts, distinct counts, running counts,
ratios, time ranges, modes and date parts come out, then leave-one-fold-out
label encodings, boosted trees per fold, exact AUC and averaged predictions.
"""

__version__ = "0.1.0"
