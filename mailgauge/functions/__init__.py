"""Column functions: tokens and counts, header text, dates, recipients.

The parts of the parser (headers, dates, recipients) take and give SQL
expression text.  A Column is built with one call into the JVM per node, and
the parser has a few thousand nodes; as text it is one call per step.
"""
