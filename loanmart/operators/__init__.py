"""Relational operators over DataFrames (G*, J*, O*, U*, K5, P17, V*, N*)."""
