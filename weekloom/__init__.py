"""Weekly chart and series analytics on Spark DataFrames.

Layers, from the bottom up:

``functions``  column expressions (text, dates, numbers, labels, JSON payloads)
``sources``    readers and writers
``operators``  DataFrame -> DataFrame building blocks
``plans``      whole jobs composed from the operators
``queries``    every operator run over the generated tables, with its SQL twin
"""
