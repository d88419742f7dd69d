"""Layered warehouse on Spark: feeds -> landing -> staging -> star schema."""
