"""The engine's operators run over the driver's tables, with an SQL oracle for each."""
