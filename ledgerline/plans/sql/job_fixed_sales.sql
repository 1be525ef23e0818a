
WITH s AS (
  SELECT o_orderkey AS id_venta, o_orderdate AS fecha_estado,
    nullif(CASE WHEN o_orderstatus = 'P' THEN 'NP' ELSE o_orderstatus END, 'O') AS red,
    CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'NEG_P' WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE 'ALTA' END AS tipo_v,
    CASE WHEN o_totalprice < 30000 THEN 'NEG_P' ELSE 'VENTA' END AS tipo_venta,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'SIN ASIGNACION' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'VENTAS SIN ASIGNAR'
         ELSE 'JEFE ' || CAST(o_custkey % 5 AS VARCHAR) END AS jefe,
    CASE o_custkey % 5 WHEN 0 THEN ' SIN ASIGNACIÓN' || chr(10) WHEN 1 THEN 'Espa' || chr(65533) || 'a' WHEN 2 THEN 'OTRA'
         ELSE 'GERENCIA NORTE' END AS gerencia,
    CASE WHEN o_custkey % 5 = 3 THEN 'SIN ASIGNACI?N' ELSE 'JEFATURA SUR' END AS jefatura,
    CASE WHEN o_custkey % 5 = 4 THEN 'NO APLICA' ELSE 'CONSULTOR ' || CAST(o_custkey % 5 AS VARCHAR) END AS consultor,
    CASE WHEN o_custkey % 5 = 1 THEN 'NO APLICA' ELSE 'COORD' END AS coordinador,
    CASE WHEN o_custkey % 5 = 2 THEN 'NO REGISTRA' ELSE 'INTERNET' END AS linea_1_pyme,
    ['ENERO','FEBRERO','MARZO','ABRIL','MAYO','JUNIO','JULIO','AGOSTO','SEPTIEMBRE','OCTUBRE','NOVIEMBRE','DICIEMBRE'][month(o_orderdate)] AS mes_gestion,
    CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE 'CALLE 1' END AS direccion,
    CASE WHEN o_custkey % 5 = 1 THEN NULL ELSE o_orderdate END AS fecha_legalizacion
  FROM orders
  WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-03-13' AND DATE '1998-03-15'),
k AS (SELECT * FROM s WHERE red IS DISTINCT FROM 'NP' AND tipo_v IS DISTINCT FROM 'NEG_P'
                      AND tipo_venta IS DISTINCT FROM 'NEG_P'),
c AS (SELECT id_venta, fecha_estado, replace(red, chr(65533), 'ñ') AS red, replace(tipo_v, chr(65533), 'ñ') AS tipo_v, replace(tipo_venta, chr(65533), 'ñ') AS tipo_venta,
        replace(CASE WHEN jefe IN ('SIN ASIGNACION', 'VENTAS SIN ASIGNAR', 'NO APLICA') THEN 'OTROS' ELSE jefe END, chr(65533), 'ñ') AS jefe,
        replace(gerencia, chr(65533), 'ñ') AS gerencia, replace(jefatura, chr(65533), 'ñ') AS jefatura, replace(consultor, chr(65533), 'ñ') AS consultor,
        replace(coordinador, chr(65533), 'ñ') AS coordinador, replace(linea_1_pyme, chr(65533), 'ñ') AS linea_1_pyme, replace(mes_gestion, chr(65533), 'ñ') AS mes_gestion,
        replace(direccion, chr(65533), 'ñ') AS direccion, fecha_legalizacion FROM k)
SELECT 'RUN-FIJO-0001' AS id_ejecucion,
  id_venta, fecha_estado, red, tipo_v, tipo_venta, jefe,
  CASE WHEN regexp_replace(regexp_replace(gerencia, '^\s+|\s+$', '', 'g'), '[\n\r\t]+', '', 'g') IN ({spellings}) THEN 'OTROS' ELSE regexp_replace(regexp_replace(gerencia, '^\s+|\s+$', '', 'g'), '[\n\r\t]+', '', 'g') END AS gerencia, CASE WHEN regexp_replace(regexp_replace(jefatura, '^\s+|\s+$', '', 'g'), '[\n\r\t]+', '', 'g') IN ({spellings}) THEN 'OTROS' ELSE regexp_replace(regexp_replace(jefatura, '^\s+|\s+$', '', 'g'), '[\n\r\t]+', '', 'g') END AS jefatura, CASE WHEN regexp_replace(regexp_replace(consultor, '^\s+|\s+$', '', 'g'), '[\n\r\t]+', '', 'g') IN ({spellings}) THEN 'OTROS' ELSE regexp_replace(regexp_replace(consultor, '^\s+|\s+$', '', 'g'), '[\n\r\t]+', '', 'g') END AS consultor,
  CASE WHEN coordinador = 'NO APLICA' THEN 'OTROS' ELSE coordinador END AS coordinador,
  CASE WHEN linea_1_pyme = 'NO REGISTRA' THEN 'OTROS' ELSE linea_1_pyme END AS linea_1_pyme,
  mes_gestion, ['01.Enero','02.Febrero','03.Marzo','04.Abril','05.Mayo','06.Junio','07.Julio','08.Agosto','09.Septiembre','10.Octubre','11.Noviembre','12.Diciembre'][list_position(['ENERO','FEBRERO','MARZO','ABRIL','MAYO','JUNIO','JULIO','AGOSTO','SEPTIEMBRE','OCTUBRE','NOVIEMBRE','DICIEMBRE'], upper(regexp_replace(mes_gestion, '^\s+|\s+$', '', 'g')))] AS mes_gestion_numero,
  coalesce(direccion, 'NO REGISTRA') AS direccion,
  coalesce(fecha_legalizacion, TIMESTAMP '1900-01-01 00:00:00') AS fecha_legalizacion,
  TIMESTAMP '1998-03-16 06:00:00' AS fecha_procesamiento, 'VENTAS FIJO' AS fuente, '1' AS id_estado
FROM c
