"""P1 from raw report CSVs (upper-case Spanish headers, two dispatch rule variants)."""
import os

from brasa.plans.pipelines import preprocessing_raw
from brasa.sources.files import load_csv

FIRE_HEADER = ("FICHA;LATITUD;LONGITUD;REGION;PROVINCIA;COMUNA;PREDIO;TEMPORADA;INICIO;ARRIBO;CONTROL;EXTINCION;"
               "ZONA_META;COMBUSTIBLE_INICIAL;PIRA;EUCA;OTRAS;GRUPO_CAUSAL;CAUSA;CLASE;SUP_INICIAL;SUP;GASTO_COMBATE_UF")


def fire_row(ficha, start, arrival, zone_meta="UNIDAD BASICA", sup="0,5", sup_final="1,0 m2"):
    return (f"{ficha};-37,1;-72,9;BIOBIO;ARAUCO;LEBU;P1;2020;{start};{arrival};{arrival};{arrival};{zone_meta};"
            f"Pastizal;0;0;0;G;C;A;{sup};{sup_final};1")


DISP_HEADER = ("ID_FOCO_INCENDIO;ID_DESPACHO;TIPO_FICHA;ZONA;GLOSA;HR_DESPACHO;HR_SALIDA;HR_ARRIBO;HR_COMBATE;"
               "HR_TL;HR_CONTROL;HR_LIQUIDACION;HR_EXTINCION;HR_RETIRO;HR_LLEGADA")


def disp_row(fid, did, arribo, glosa, tipo="FOCO", zona="ZONA ARAUCO"):
    return f"{fid};{did};{tipo};{zona};{glosa};{arribo};{arribo};{arribo};{arribo};;;;;;"


def _w(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_raw_preprocessing(spark, tmp):
    _w(f"{tmp}/f/incendios_2020.csv", [FIRE_HEADER,
        fire_row(100000001, "2020-01-10 10:00", "2020-01-10 10:30"),        # shifted dispatch clock
        fire_row(100000002, "2020-01-10 11:00", "2020-01-10 11:20"),
        fire_row(100000003, "2020-01-10 12:00", "2020-01-10 12:10", zone_meta="OTRA"),  # recoded away
        fire_row(12345, "2020-01-10 12:00", "2020-01-10 12:10"),             # short id
        fire_row(100000004, "2020-01-10 13:00", "2020-01-10 13:10")])        # no dispatch
    _w(f"{tmp}/d/despachos_a.csv", [DISP_HEADER,
        disp_row(100000001, 1, "2020-01-10 09:30", "H12"),
        disp_row(100000001, 1, "2020-01-10 09:31", "H99"),                   # duplicate std id: first kept
        disp_row(100000002, 1, "2020-01-10 11:20", "B7 EXTRA", tipo="ALARMA")])
    _w(f"{tmp}/d/despachos_b.csv", [DISP_HEADER,
        disp_row(100000002, 2, "2020-01-10 11:20", "BHA-5 x"),
        disp_row(100000003, 1, "2020-01-10 12:10", "AA3 - foo"),
        disp_row(100000009, 1, "2020-01-10 12:10", "BA1 sur")])              # no fire
    fires = load_csv(spark, f"{tmp}/f")
    disp = load_csv(spark, f"{tmp}/d")
    f, d = preprocessing_raw(fires, disp, v1_sources=["despachos_a"], v2_sources=["despachos_b"])
    fr = {r["fire_id"]: r for r in f.collect()}
    assert set(fr) == {100000001, 100000002}
    assert fr[100000001]["zone"] == "ARAUCO" and fr[100000001]["target_zone"] == "BASICA"
    assert fr[100000001]["initial_surface_ha"] == 0.5 and fr[100000001]["final_surface_ha"] == 1.0
    dr = sorted((r["fire_id"], r["id_despacho"], r["glosa"], str(r["hr_arribo"])) for r in d.collect())
    assert dr == [(100000001, 1, "BHA12", "2020-01-10 10:30:00"),
                  (100000002, 2, "BHA5", "2020-01-10 11:20:00"),
                  (100000003, 1, "AA3", "2020-01-10 12:10:00")]
