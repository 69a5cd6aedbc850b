from riskframe.streaming.psi_stream import PsiBaseline, fit_baseline, psi_window_counts, start_psi_monitor

__all__ = ["PsiBaseline", "fit_baseline", "psi_window_counts", "start_psi_monitor"]
