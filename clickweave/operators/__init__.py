"""Relational operators built from DataFrame calls: sequences (lag / lead,
running positions), grouped aggregates joined back, modes, dictionary codes,
out-of-fold encoders, folds, exact AUC and hot-key splitting."""
