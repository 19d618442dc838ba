"""Building blocks of the reports: visits, cubes, exact distinct counts, page flow, lifecycle."""
