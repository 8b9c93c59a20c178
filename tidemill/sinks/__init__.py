"""Writers to topics, dimension tables, report tables and the console."""
