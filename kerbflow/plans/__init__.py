"""Query plans over the driver's test tables.

``standins`` maps the tables onto trip-shaped frames (and the same mapping as
DuckDB SQL); ``catalog`` registers one query per operator; ``oracle`` holds the
SQL each query is checked against.
"""
