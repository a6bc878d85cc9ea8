"""rankfold: explicit-rating analytics and biased matrix factorisation on Spark.

Everything is expressed as DataFrame plans over rating, catalogue and model
tables; Python workers are used only for the per-entity least-squares solve,
the block scorer and the per-pair streaming state.
"""

__version__ = "0.1.0"
