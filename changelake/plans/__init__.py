"""Plan building blocks: filter expressions, joins and ordered computations that survive hot keys."""
