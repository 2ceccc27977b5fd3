"""SQL text of the expressions the operators share.

Expressions are kept as text because one parse is one call to the JVM, while a chain of
Column operators costs several calls for each operator; a query of this package would spend
more time being put together than a small table takes to read.
"""
