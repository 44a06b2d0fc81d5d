"""Table operators: preparation, features, scaling, clustering and reports."""
