"""edcohort: cohort building and evaluation for event-style clinical data on Spark.

Every public operator is a DataFrame -> DataFrame function whose column names are
parameters, so it runs unchanged on any table of the same shape.

Sub-packages
------------
sources     scans and sinks (delimited lab extracts, visit tables, versioned
            data-model datasets, fitted-model store, hyper-parameter table)
functions   column-expression builders (parsing, result normalisation, clinical
            derivations, risk scores)
operators   relational operators (presentation building, cohort joins, global
            ordinals and folds, metrics, imputation, learning, attribution)
plans       end-to-end compositions (build, derive, evaluate, baseline table)
            and the bindings to the driver tables
"""

__version__ = "0.1.0"
