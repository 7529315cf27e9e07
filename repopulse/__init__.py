"""Repository-trend analytics as Spark DataFrame operators.

``functions``  column expressions (no Python UDFs)
``sources``    readers and writers for landed files
``operators``  DataFrame -> DataFrame steps
``plans``      whole jobs composed from the operators
``streaming``  file landing and the streaming event normaliser
"""
