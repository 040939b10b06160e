"""tokenloom: corpus preparation and training-log analytics as Spark jobs.

Every operator is a plain function from DataFrame(s) to DataFrame. Token
streams are kept physically as BINARY per document (one byte per token for
``width=1``, little-endian uint16 for ``width=2``) so that shuffles move
compact bytes; integer arrays are produced only where a caller asks for them.
"""

__version__ = "0.1.0"
