"""The reports: promo report, legacy report, qualifying sales and
reconciliation, presentation."""
