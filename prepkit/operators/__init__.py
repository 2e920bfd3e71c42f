"""DataFrame operators: profiling, cleaning, imputing, joining, scaling, splitting."""
