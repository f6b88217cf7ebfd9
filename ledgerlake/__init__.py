"""ledgerlake: a Spark-native medallion engine for electronic invoices.

Raw invoice documents (XML) and keyed JSON messages land unchanged in a raw
(bronze) layer, are cleaned into a typed, validated, deduplicated silver
layer, pass a quality gate, and are modelled as a star schema (issuer,
calendar and location dimensions around a sales fact) that answers revenue
questions by state, issuer and month.

Every operator is a DataFrame -> DataFrame function that runs on executors;
I/O lives only in ``sources`` and ``sinks``.
"""

__version__ = "0.1.0"
